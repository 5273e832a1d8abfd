"""Token counts that follow edits: a segment tree over pre-token boundaries for each document."""

from __future__ import annotations

import base64
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# The pre-token pattern that belongs to this vocabulary: a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LEAF = 256
"""Characters from which a leaf ends at the next cut."""
CUT = re.compile(r"(?<=\S)[ \n](?=\S)")
"""A single space or line end between other characters: a pre-token always begins here, whatever lies further off."""
REACH = 1
"""Characters on either side of a cut on which it depends."""
MAX_VOCABULARY = 64 << 20
"""Largest vocabulary file, in bytes, that is sent to the tasks."""

TREE = T.StructType([T.StructField("chars", T.ArrayType(T.LongType())), T.StructField("tokens", T.ArrayType(T.LongType()))])
ARROW_TREE = pa.struct([("chars", pa.list_(pa.int64())), ("tokens", pa.list_(pa.int64()))])
EDITS = "array<struct<start:bigint,end:bigint,text:string>>"


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a vocabulary file: base64 of the token, a space, the rank, line by line."""
    if Path(path).stat().st_size > MAX_VOCABULARY:
        raise ValueError(f"{path} is too large to send to all tasks")
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, Path(path).read_bytes().splitlines())}


def counter(ranks: dict[bytes, int]) -> Callable[[str], int]:
    import tiktoken

    encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: len(encoding.encode_ordinary(text))


def cuts(text: str) -> list[int]:
    """Where leaves begin."""
    places = [0]
    while found := CUT.search(text, places[-1] + LEAF):
        places.append(found.start())
    return places


def build_tree(text: str, count: Callable[[str], int]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of characters and tokens: node i has the children 2i and 2i + 1, the leaves fill the second half."""
    places = [*cuts(text), len(text)]
    leaves = len(places) - 1
    width = 1 << (leaves - 1).bit_length()
    chars, tokens = np.zeros(2 * width, np.int64), np.zeros(2 * width, np.int64)
    chars[width : width + leaves] = np.diff(places)
    tokens[width : width + leaves] = [count(text[a:b]) for a, b in zip(places[:-1], places[1:], strict=True)]
    for low in (width >> k for k in range(1, width.bit_length())):
        for sums in (chars, tokens):
            sums[low : 2 * low] = sums[2 * low : 4 * low].reshape(-1, 2).sum(axis=1)
    return chars, tokens


def leaf_at(chars: np.ndarray, place: int) -> tuple[int, int]:
    """The leaf that holds a character, and where it begins; past the end, the last leaf with characters."""
    node, begin, width = 1, 0, len(chars) // 2
    place = min(place, max(int(chars[1]) - 1, 0))
    while node < width:
        node *= 2
        if place >= begin + chars[node]:
            begin += int(chars[node])
            node += 1
    return node, begin


def set_leaf(chars: np.ndarray, tokens: np.ndarray, leaf: int, n_chars: int, n_tokens: int) -> None:
    """Change a leaf and the sums above it."""
    more_chars, more_tokens = n_chars - chars[leaf], n_tokens - tokens[leaf]
    while leaf:
        chars[leaf] += more_chars
        tokens[leaf] += more_tokens
        leaf //= 2


def valid_edits(edits: list[dict] | None, length: int) -> list[tuple[int, int, str]]:
    """Edits in order, kept within the text; one that overlaps an earlier one is ignored, as is one with a null bound."""
    kept: list[tuple[int, int, str]] = []
    for edit in sorted((e for e in edits or () if e and e["start"] is not None and e["end"] is not None), key=lambda e: (e["start"], -e["end"], e["text"] or "")):
        start = min(max(edit["start"], 0), length)
        end = min(max(edit["end"], start), length)
        if not kept or start >= kept[-1][1]:
            kept.append((start, end, edit["text"] or ""))
    return kept


def edit_tree(text: str, chars: np.ndarray, tokens: np.ndarray, edits: list[tuple[int, int, str]], count: Callable[[str], int]) -> tuple[str, int]:
    """Apply edits to a text and its tree; the new text and how many of its characters were encoded again.

    The last edit comes first, so that the places of the others still hold.
    The leaves that an edit touches, and a neighbour whose border lies within reach
    of it, become one leaf; its first slot takes the new sums, the others become empty.
    """
    width = len(chars) // 2
    again = 0
    for start, end, new in reversed(edits):
        first, begin = leaf_at(chars, max(start - REACH - 1, 0))
        last, last_begin = leaf_at(chars, end + REACH)
        stop = last_begin + int(chars[last])
        part = text[begin:start] + new + text[end:stop]
        text = text[:begin] + part + text[stop:]
        set_leaf(chars, tokens, first, len(part), count(part))
        for leaf in range(first + 1, min(last, 2 * width - 1) + 1):
            if chars[leaf]:
                set_leaf(chars, tokens, leaf, 0, 0)
        again += len(part)
    return text, again


def _trees(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for tree in column:
        yield tuple(np.array(tree[k].values) for k in ("chars", "tokens"))


def _append(batch: pa.RecordBatch, made: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch with columns added or replaced."""
    names = [n for n in batch.schema.names if n not in made]
    return pa.RecordBatch.from_arrays([batch.column(n) for n in names] + list(made.values()), names=[*names, *made])


def count_tokens(docs: DataFrame, text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``docs`` with ``tree``, the segment tree of its text, and ``n_tokens``.

    Leaves end at cuts where a pre-token begins whatever the rest of the text
    is, so the sum of their counts is the count of the text. A null or empty text
    has one empty leaf and no tokens; a text without a cut is one leaf. Only the
    row's own text is looked at; columns with these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(shared.value)
        for batch in batches:
            trees = [build_tree(text or "", count) for text in batch.column(text_col).to_pylist()]
            stored = pa.array([{"chars": c, "tokens": t} for c, t in trees], ARROW_TREE)
            yield _append(batch, {"tree": stored, "n_tokens": pa.array([int(t[1]) for _, t in trees], pa.int64())})

    docs = docs.drop("tree", "n_tokens")
    return docs.mapInArrow(task, T.StructType([*docs.schema, T.StructField("tree", TREE), T.StructField("n_tokens", T.LongType())]))


def recount_tokens(counted: DataFrame, edits_col: str = "edits", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """Apply each row's edits to its text, ``tree`` and ``n_tokens``; ``n_reencoded`` has the characters encoded again.

    ``edits_col`` is an array of ``start``, ``end`` (characters of the text, the
    end exclusive) and ``text``, the replacement. Bounds are moved into the
    text; of overlapping edits the one that starts first, then the longer one,
    counts. A null array, or one without edits, changes nothing; a null text is empty.
    """
    shared = counted.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(shared.value)
        for batch in batches:
            texts, trees, again = [], [], []
            columns = (batch.column(text_col).to_pylist(), _trees(batch.column("tree")), batch.column(edits_col).to_pylist())
            for text, (chars, tokens), edits in zip(*columns, strict=True):
                chars, tokens = chars.copy(), tokens.copy()
                text, n = edit_tree(text or "", chars, tokens, valid_edits(edits, len(text or "")), count)
                texts.append(text)
                trees.append({"chars": chars, "tokens": tokens})
                again.append(n)
            made = {text_col: pa.array(texts, pa.string()), "tree": pa.array(trees, ARROW_TREE)}
            made["n_tokens"] = pa.array([int(t["tokens"][1]) for t in trees], pa.int64())
            yield _append(batch, {**made, "n_reencoded": pa.array(again, pa.int64())})

    made = [text_col, "tree", "n_tokens", "n_reencoded"]
    kept = [f for f in counted.schema if f.name not in made]
    added = [T.StructField(text_col, T.StringType()), T.StructField("tree", TREE), T.StructField("n_tokens", T.LongType()), T.StructField("n_reencoded", T.LongType())]
    return counted.mapInArrow(task, T.StructType([*kept, *added]))


def sample_edits(n_chars: Column, insert: Column, replace: Column) -> Column:
    """Three edits of a text: words put in after a third, twenty characters cut from the middle, five replaced after two thirds."""
    third, half = (n_chars / 3).cast("bigint"), (n_chars / 2).cast("bigint")

    def edit(start: Column, length: int, text: Column) -> Column:
        return F.struct(start.alias("start"), (start + length).alias("end"), text.alias("text"))

    return F.array(edit(third, 0, insert), edit(half, 20, F.lit("")), edit(2 * third, 5, replace)).cast(EDITS)
