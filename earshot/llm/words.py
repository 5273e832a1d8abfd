"""Hashes of the words of whole texts, computed over Arrow buffers.

Words are runs of characters other than space and the control characters 9 to
13; none of these bytes occurs inside a longer UTF-8 sequence, so words are cut
in the bytes. A-Z are lower-cased. A batch is worked on in pieces of a few
hundred kilobytes, or one text where a text is longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 18
"""Bytes of text that are worked on at once, if they are not one longer text."""


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of SplitMix64: each output bit depends on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit constants."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def is_space() -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[[9, 10, 11, 12, 13, 32]] = True
    return table


def byte_values() -> np.ndarray:
    """A 64-bit value for each byte: 0 for white space, equal for both cases of A-Z."""
    values = constants(256, 7)
    values[65:91] = values[97:123]
    values[is_space()] = 0
    return values


SPACE = is_space()
VALUES = byte_values()
BASE = 0x9FB21C651E98DF25


def powers(n: int) -> np.ndarray:
    steps = np.full(n, BASE, dtype=np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def word_hashes(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and text number of each word of the texts ``data[edges[i]:edges[i + 1]]``."""
    inside = ~SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = edges[:-1][edges[:-1] < edges[1:]]
    first[begins] = inside[begins]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, starts
    place = np.arange(len(data))
    place[starts[0] :] -= np.repeat(starts, np.diff(starts, append=len(data)))
    values = VALUES[data] * powers(int(place.max()) + 1)[place]
    return mix(np.add.reduceat(values, starts)), starts, np.searchsorted(edges, starts, side="right") - 1


def texts(column: pa.Array | pa.ChunkedArray, piece: int = PIECE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Pieces of a text column: number of the first row, bytes, and where each text begins; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + piece, side="right")) - 1)
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def text_words(column: pa.Array, piece: int = PIECE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Pieces of a text column: number of the first row, word hashes, and where the words of each text begin."""
    for row, data, edges in texts(column, piece):
        hashes, _, owner = word_hashes(data, edges)
        yield row, hashes, np.searchsorted(owner, np.arange(len(edges)))


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` words."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    factors = constants(n, 11 * n)
    total = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        total += words[k : len(words) - n + 1 + k] * factors[k]
    return mix(total)
