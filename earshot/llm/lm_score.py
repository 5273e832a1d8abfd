"""Language-model scores from a log-frequency Bloom filter of quantised n-gram counts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.words import PIECE, constants, mix, text_words
from earshot.operators.sizing import scratch_path, staged

BASE = 1.5
"""Counts are kept as 1 + floor(log count to this base): small counts exactly, large ones to a fifth."""
BITS = 10
"""Bits of the filter for each entry; with six probes one absent entry in a hundred looks present."""
PROBES = 6
MAX_BYTES = 128 << 20
"""Most bytes of a filter that is sent to all tasks; a larger one stays in its shards, and the keys of the texts go there."""
GROUP_BYTES = 4 << 20
"""Bytes of the shards of a large filter that are probed together."""
BLOCK_ROWS, BLOCK_BYTES = 1024, 1 << 20
"""Most texts, and bytes of texts, that ask for their keys at once."""
COMMON = 1e-6
"""Share of all tokens from which a word is common; there are at most 1 / COMMON common words.

Tasks have the counts of common words at hand. What is learned and scored does not depend on it."""
SHARD_TOKENS = 1 << 16
PACKED_SHARDS, SHARDS_PACKED = 1 << 11, 1 << 5
"""Shards up to which each has counts packed by itself, and how many larger numbers of shards share a packet."""
PACKED_KEYS = 1 << 20
"""Keys, at least, that are packed together, if a task has so many; at most twice as many."""
SCORED = 1 << 18
"""Tokens, at least, whose distinct keys are probed together, if a batch has so many."""
PROBED, LEVELS_AT_ONCE = 1 << 15, 4
"""Keys that are probed together, and how many levels far; those of higher levels are gathered again."""
GRID = (0.0, 0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
LEVELS = 64
END, BEGIN = (int(x) for x in constants(2, 101))
PAIR = constants(2, 103)


def level_of(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(np.maximum(counts, 1)) / np.log(BASE) + 1e-9).astype(np.int64)


def level_values() -> np.ndarray:
    """Mean of the whole numbers that share a level, by level; level 0 is 0."""
    values = [0.0]
    for q in range(1, LEVELS):
        low, high = np.ceil(BASE ** (q - 1) - 1e-9), np.ceil(BASE**q - 1e-9) - 1
        values.append((low + high) / 2 if high >= low else BASE ** (q - 0.5))
    return np.array(values)


VALUES = level_values()


def tokens_of(column: pa.Array, least: int = 0) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Pieces of a text column: first row, tokens with one end for each text, and where each text begins.

    Pieces of fewer than ``least`` tokens are joined with the next.
    """
    first, held, sizes = 0, [], []
    for _, words, edges in text_words(column):
        size = np.diff(edges) + 1
        ends = np.cumsum(size) - 1
        tokens = np.full(size.sum(), END, np.uint64)
        inside = np.ones(len(tokens), bool)
        inside[ends] = False
        tokens[inside] = words
        held.append(tokens)
        sizes.append(size)
        if sum(map(len, held)) >= least:
            yield first, np.concatenate(held), np.append(0, np.cumsum(np.concatenate(sizes)))
            first, held, sizes = first + sum(map(len, sizes)), [], []
    if held:
        yield first, np.concatenate(held), np.append(0, np.cumsum(np.concatenate(sizes)))


def distinct_words(tokens: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct tokens with the begin at their end, the place of each token there, and that of its history."""
    words, place = np.unique(tokens, return_inverse=True)
    before = np.empty_like(place)
    before[1:] = place[:-1]
    before[starts[:-1]] = len(words)
    return np.append(words, np.uint64(BEGIN)), place, before


def pair_keys(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    return mix(before * PAIR[0] + tokens * PAIR[1])


def find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether keys are in a sorted table, and where."""
    place = np.searchsorted(table, keys)
    place[place == len(table)] = 0
    return (table[place] == keys) if len(table) else np.zeros(len(keys), bool), place


def _totals(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([k for k, _ in parts])
    order = np.argsort(keys)
    keys = keys[order]
    counts = np.concatenate([n for _, n in parts])[order]
    lows = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[lows], np.add.reduceat(counts, lows) if len(lows) else counts


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with their counts in each batch; the begin of a text counts as a word that is only ever a history."""
    for batch in batches:
        parts = [(np.array([BEGIN], np.uint64), np.array([batch.num_rows]))]
        for _, tokens, _ in tokens_of(batch.column(0)):
            parts.append(np.unique(tokens, return_counts=True))
        keys, counts = _totals(parts)
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], names=["key", "n"])


def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of a token and the one before it with their counts in each batch."""
    for batch in batches:
        parts = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        for _, tokens, starts in tokens_of(batch.column(0)):
            distinct, _, before = distinct_words(tokens, starts)
            parts.append(np.unique(pair_keys(distinct[before], tokens), return_counts=True))
        keys, counts = _totals(parts)
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], names=["key", "n"])


def by_group(keys: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order of the keys by group (their last bits; ``groups`` is a power of two), the groups that occur, and their edges."""
    group = (keys & np.uint64(groups - 1)).view(np.int64)
    order = np.argsort(group.astype(np.uint16) if groups <= 1 << 16 else group, kind="stable")
    group = group[order]
    lows = np.flatnonzero(np.diff(group, prepend=-1))
    return order, group[lows], np.append(lows, len(keys))


def packed(groups: int, counted: Callable = iter) -> Callable:
    """Keys with their counts as a row for each group, so that a shuffle moves packets and not single keys."""

    def packets(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        keys, counts = (np.concatenate([part.column(c).to_numpy() for part in parts]) for c in ("key", "n"))
        keys = keys.view(np.uint64)
        order, group, edges = by_group(keys, groups)
        keys, counts = keys[order], counts[order].view(np.uint64)
        ranges = list(zip(edges[:-1], edges[1:], strict=True))
        narrow = [counts[a:b].astype(np.min_scalar_type(counts[a:b].max())).tobytes() for a, b in ranges]
        arrays = [pa.array(group.astype(np.int32)), pa.array([keys[a:b].tobytes() for a, b in ranges], pa.binary()), pa.array(narrow, pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, names=["group", "keys", "counts"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in counted(batches):
            for low in range(0, batch.num_rows, PACKED_KEYS):
                held.append(batch.slice(low, PACKED_KEYS))
                if sum(part.num_rows for part in held) >= PACKED_KEYS:
                    yield packets(held)
                    held = []
        if held:
            yield packets(held)

    return task


def unpacked(shards: int) -> Callable:
    """The packets, which come by group, as rows sorted by shard within each group."""

    def rows(held: list[tuple[bytes, bytes, bool]]) -> pa.RecordBatch:
        keys = np.frombuffer(b"".join(k for k, _, _ in held), np.uint64)
        sizes = [len(k) // 8 for k, _, _ in held]
        counts = np.concatenate([np.frombuffer(n, f"u{len(n) // size}").astype(np.int64) for size, (_, n, _) in zip(sizes, held, strict=True)])
        single = np.repeat([word for _, _, word in held], sizes)
        order, shard, edges = by_group(keys, shards)
        columns = (keys[order].view(np.int64), counts[order], single[order], np.repeat(shard.astype(np.int32), np.diff(edges)))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["key", "n", "word", "shard"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            columns = [batch.column(c) for c in ("group", "keys", "counts", "word")]
            for group, keys, counts, word in zip(*columns, strict=True):
                if group.as_py() != now and held:
                    yield rows(held)
                    held = []
                now = group.as_py()
                held.append((keys.as_py(), counts.as_py(), word.as_py()))
        if held:
            yield rows(held)

    return task


def first_probe(keys: np.ndarray, level: int) -> np.ndarray:
    """The first probe of keys at a level, before it is cut to the size of the bit array."""
    return mix(keys + np.array([level], np.uint64) * PAIR[0])


def step_of(first: np.ndarray) -> np.ndarray:
    """The step from each probe to the next."""
    return mix(first) | np.uint64(1)


def inverse_of(bits: np.ndarray | int) -> np.ndarray:
    """One by the bits, so much too small that a quotient by it is never too large, and at most one too small."""
    return (1 - 2.0**-51) / np.asarray(bits, np.float64)


def position(probe: np.ndarray, bits: np.ndarray, inverse: np.ndarray) -> np.ndarray:
    """The upper 56 bits of a probe modulo the bits, at least 64; an unsigned division takes several times as long."""
    x = probe >> np.uint64(8)
    rest = x - (x.view(np.int64) * inverse).astype(np.int64).view(np.uint64) * bits
    return np.minimum(rest, rest - bits).view(np.int64)  # below zero is beyond all unsigned numbers


def build_filter(max_bits: int | None = None) -> Callable:
    """A Bloom filter of each shard; rows come sorted by shard, with ``key`` and ``n``.

    Counts of a key are added up, a pair needs two occurrences. A key is entered
    once for each level up to that of its count.
    """

    def bits_of(keys: np.ndarray, counts: np.ndarray, single: np.ndarray) -> bytes:
        keys, inverse = np.unique(keys, return_inverse=True)
        total = np.bincount(inverse, counts, len(keys))
        alone = np.zeros(len(keys), bool)
        alone[inverse] = single
        stored = alone | (total >= 2)
        keys, levels = keys[stored], level_of(total[stored])
        size = int(max(64, BITS * levels.sum()))
        size = size if max_bits is None else min(max_bits, size)
        size = (size + 7) // 8 * 8
        flags = np.zeros(size, bool)
        for level in range(1, int(levels.max()) + 1 if len(levels) else 1):
            probe = first_probe(keys[levels >= level], level)
            step = step_of(probe)
            for _ in range(PROBES):
                flags[position(probe, np.uint64(size), inverse_of(size))] = True
                probe += step
        return np.packbits(flags, bitorder="little").tobytes()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None

        def finish(table: pa.Table) -> pa.RecordBatch:
            shard = table.column("shard").to_numpy()
            keys, n = table.column("key").to_numpy().view(np.uint64), table.column("n").to_numpy()
            single = table.column("word").to_numpy()
            cuts = np.append(np.flatnonzero(np.diff(shard)) + 1, len(shard))
            lows = np.append(0, cuts[:-1])
            made = [bits_of(keys[a:b], n[a:b], single[a:b]) for a, b in zip(lows, cuts, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(shard[lows]), pa.array(made, pa.binary())], names=["shard", "bits"])

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if kept is None else pa.concat_tables([kept, table])
            shard = table.column("shard").to_numpy()
            cut = int(np.argmax(shard == shard[-1]))
            if cut:
                yield finish(table.slice(0, cut))
            kept = table.slice(cut)
        if kept is not None:
            yield finish(kept)

    return task


def entered(data: np.ndarray, keys: np.ndarray, start: np.ndarray, bits: np.ndarray, inverse: np.ndarray, level: int) -> np.ndarray:
    """Places of the keys that a filter holds at a level; theirs are ``bits`` bits from bit ``start``."""
    found, probe, step, held = np.arange(len(keys)), first_probe(keys, level), None, None
    for k in range(PROBES):
        if k:
            step = step_of(probe) if step is None else step
            probe = probe + step
        at = position(probe, bits, inverse)
        at += start
        bit = (data.take(at >> 3, mode="clip") >> (at.astype(np.uint8) & np.uint8(7))) & np.uint8(1)
        held = bit.view(bool) if held is None else held & bit.view(bool)
        if np.count_nonzero(held) < 0.9 * len(held):  # what is absent needs no further probe
            found, start, bits, inverse, probe = (x[held] for x in (found, start, bits, inverse, probe))
            step = step if step is None else step[held]
            held = None
    return found if held is None else found[held]


def levels(model: tuple, keys: np.ndarray) -> np.ndarray:
    """The level of each key: probed upwards until a level is absent.

    The number of shards is a power of two. Keys are probed in the order of
    their shards and a few at a time, so that what they need stays in the cache.
    """
    data, offsets, sizes = model
    out = np.zeros(len(keys), np.int64)
    shard = (keys & np.uint64(len(sizes) - 1)).view(np.int64)
    alive = np.argsort((shard >> max(0, len(sizes).bit_length() - 17)).astype(np.uint16), kind="stable")
    alive = alive[sizes[shard[alive]] > 0]
    low = 1
    while len(alive) and low < LEVELS:
        high, left = min(low + LEVELS_AT_ONCE, LEVELS), []
        for a in range(0, len(alive), PROBED):
            part = alive[a : a + PROBED]
            bits = sizes[shard[part]]
            columns = (part, keys[part], 8 * offsets[shard[part]], bits.view(np.uint64), inverse_of(bits))
            for level in range(low, high):
                kept = entered(data, *columns[1:], level)
                if len(kept) < len(columns[0]):
                    columns = tuple(x.take(kept) for x in columns)
                out[columns[0]] = level
                if not len(kept):
                    break
            left.append(columns[0])
        alive, low = np.concatenate(left), high
    return out


def no_levels(common: np.ndarray) -> np.ndarray:
    """Room for the levels of the common words, which a task looks up once."""
    return np.full(max(1, len(common)), -1, np.int8)


def token_levels(look: Callable, common: np.ndarray, seen: np.ndarray, tokens: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Levels of each token, of its history and of the pair; whether the token is common, and its place among the common ones.

    ``look`` finds the levels of distinct keys; those of common words are kept in ``seen``.
    """
    words, place, before = distinct_words(tokens, starts)
    hit, at = find(common, words)
    level = np.where(hit, seen[at], -1).astype(np.int64)
    new = level < 0
    level[new] = look(words[new])
    seen[at[hit]] = level[hit]
    both = (level[place] > 0) & (level[before] > 0)  # a word that was never learned is in no pair
    keys, where = np.unique(pair_keys(words[before[both]], tokens[both]), return_inverse=True)
    pair = np.zeros(len(tokens), np.int64)
    pair[both] = look(keys)[where]
    return level[place], level[before], pair, hit[place], at[place]


def block_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of bounded size of ``doc_id``, ``held_out``, ``tuning``, ``text``: a row each, with lists; tuning texts apart."""
    block = TaskContext.get().partitionId() << 24
    for batch in batches:
        for tuning in (False, True):
            part = batch.filter(pc.equal(batch.column("tuning"), tuning))
            ends = np.cumsum(pc.fill_null(pc.binary_length(part.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            low = 0
            while low < part.num_rows:
                before = ends[low - 1] if low else 0
                high = min(low + BLOCK_ROWS, max(low + 1, int(np.searchsorted(ends, before + BLOCK_BYTES, side="right"))))
                rows = part.slice(low, high - low)
                lists = [pa.array([rows.column(c).to_pylist()], pa.list_(rows.column(c).type)) for c in ("doc_id", "held_out", "text")]
                yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([tuning]), *lists], names=["block", "tuning", "doc_id", "held_out", "text"])
                block += 1
                low = high


def block_keys(texts: pa.Array, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of words and pairs in some texts, by group, and the group of each."""
    parts = [np.array([BEGIN], np.uint64)]
    for _, tokens, starts in tokens_of(texts):
        words, _, before = distinct_words(tokens, starts)
        parts += [words, np.unique(pair_keys(words[before], tokens))]
    keys = np.unique(np.concatenate(parts))
    order, group, edges = by_group(keys, groups)
    return keys[order], np.repeat(group, np.diff(edges))


def ask(groups: int) -> Callable:
    """The keys of each block, a row for each group of shards."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, texts in zip(batch.column("block").to_pylist(), batch.column("text"), strict=True):
                keys, group = block_keys(texts.values, groups)
                lows = np.append(0, np.flatnonzero(np.diff(group)) + 1)
                data = [keys[a:b].tobytes() for a, b in zip(lows, np.append(lows[1:], len(keys)), strict=True)]
                arrays = [pa.array(group[lows].astype(np.int32)), pa.array([block] * len(lows), pa.int64()), pa.array(data, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["group", "block", "data"])

    return task


def answer(shards: int) -> Callable:
    """Levels of the keys of each block and group; rows come by group, those of the filter (without a block) first."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, filters, model = None, {}, None
        for batch in batches:
            made = []
            columns = [batch.column(c).to_pylist() for c in ("group", "block", "shard", "data")]
            for group, block, shard, data in zip(*columns, strict=True):
                if group != now:
                    now, filters, model = group, {}, None
                if block is None:
                    filters[shard] = data
                    continue
                model = model or shard_arrays(filters, shards)
                found = levels(model, np.frombuffer(data, np.uint64))
                made.append((block, group, found.astype(np.uint8).tobytes()))
            if made:
                types = (pa.int64(), pa.int32(), pa.binary())
                arrays = [pa.array(c, t) for c, t in zip(zip(*made, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=["block", "group", "levels"])

    return task


def shard_arrays(filters: dict[int, bytes], shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Some shards of a filter as one array, with the offset and the bits of each of all shards."""
    sizes = np.zeros(shards, np.int64)
    sizes[list(filters)] = [8 * len(b) for b in filters.values()]
    parts = [filters[k] for k in sorted(filters)]
    return np.frombuffer(b"".join(parts), np.uint8), np.append(0, np.cumsum(sizes // 8)[:-1]), sizes


def from_filter(shared) -> Callable:
    """Each batch of a table with the look-up in a filter that all tasks have."""

    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, Callable]]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            yield batch, row, lambda keys: levels(shared.value, keys)
            row += batch.num_rows

    return batches_of


def from_answers(groups: int) -> Callable:
    """Each block as a batch, with the look-up in the levels that came for its keys."""

    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, Callable]]:
        for batch in batches:
            for i, block in enumerate(batch.column("block").to_pylist()):
                arrays = {c: batch.column(c)[i].values for c in ("doc_id", "held_out", "text")}
                keys, _ = block_keys(arrays["text"], groups)
                parts = sorted((x["group"], x["levels"]) for x in batch.column("answers")[i].as_py())
                level = np.frombuffer(b"".join(x for _, x in parts), np.uint8).astype(np.int64)
                order = np.argsort(keys)
                keys, level = keys[order], level[order]
                yield pa.RecordBatch.from_pydict(arrays), block * BLOCK_ROWS, lambda k, a=keys, b=level: b[find(a, k)[1]]

    return batches_of


def tune(source: Callable, common, mass: float) -> Callable:
    """Log-likelihood of each weight of the grid by the history's level, each token's own occurrence left out.

    It depends on levels alone, so tokens are counted by the levels of word, history and pair.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times = np.zeros(LEVELS**3)
        seen = no_levels(common.value[0])
        for batch, _, look in source(batches):
            for _, tokens, starts in tokens_of(batch.column("text"), SCORED):
                cells, counts = np.unique(cell(*token_levels(look, common.value[0], seen, tokens, starts)[:3]), return_counts=True)
                times[cells] += counts
        cells = np.flatnonzero(times)
        word, history, pair = levels_of_cell(cells)
        unigram = (np.maximum(VALUES[word] - 1, 0) + 0.5) / mass
        bigram = np.minimum(np.maximum(VALUES[pair] - 1, 0) / np.maximum(VALUES[history] - 1, 1), 1)
        sums = np.zeros((LEVELS, len(GRID)))
        for g, weight in enumerate(GRID):
            sums[:, g] = np.bincount(history, times[cells] * np.log10(weight * bigram + (1 - weight) * unigram), LEVELS)
        at = np.arange(sums.size)
        arrays = [pa.array(at // len(GRID)), pa.array(at % len(GRID)), pa.array(sums.ravel())]
        yield pa.RecordBatch.from_arrays(arrays, names=["level", "grid", "total"])

    return task


def cell(word: np.ndarray, history: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """One number for the three levels of a token."""
    return (word * LEVELS + history) * LEVELS + pair


def levels_of_cell(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return cells // LEVELS**2, cells // LEVELS % LEVELS, cells % LEVELS


def cell_scores(weights: np.ndarray, mass: float) -> np.ndarray:
    """Log probability of a token by its cell."""
    word, history, pair = levels_of_cell(np.arange(LEVELS**3))
    bigram = np.minimum(VALUES[pair] / np.maximum(VALUES[history], 1), 1)
    weight = weights[history]
    return np.log10(weight * bigram + (1 - weight) * (VALUES[word] + 0.5) / mass)


def rare_tokens(tokens: np.ndarray, starts: np.ndarray, rare: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct rare tokens of each text and how often each occurs there, and how many each text has."""
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[rare]
    words, place = np.unique(tokens[rare], return_inverse=True)
    both, counts = np.unique(text * max(1, len(words)) + place, return_counts=True)
    text, place = np.divmod(both, max(1, len(words)))
    return words[place].view(np.int64), counts, np.bincount(text, minlength=len(starts) - 1)


def score_texts(source: Callable, common, weights: np.ndarray, mass: float) -> Callable:
    """Scores of each text; the base score leaves the rarer words to a join and lists them.

    The last column of a batch is the text.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, logs = common.value
        seen = no_levels(words)
        by_cell = cell_scores(weights, mass)
        logs = logs if len(logs) else np.zeros(1)
        for batch, row, look in source(batches):
            sizes, known, base, score = [], [], [], []
            rare, times, ends = [], [], []
            for _, tokens, starts in tokens_of(batch.column(batch.num_columns - 1), SCORED):
                word, history, pair, hit, place = token_levels(look, words, seen, tokens, starts)
                sizes.append(np.diff(starts))
                known.append(np.add.reduceat(hit, starts[:-1], dtype=np.int64))
                base.append(np.add.reduceat(np.where(hit, logs[place], 0.0), starts[:-1]))
                score.append(np.add.reduceat(by_cell[cell(word, history, pair)], starts[:-1]))
                for made, held in zip(rare_tokens(tokens, starts, ~hit), (rare, times, ends), strict=True):
                    held.append(made)
            n = batch.num_rows
            offsets = pa.array(np.append(0, np.cumsum(np.concatenate(ends))) if n else [0], pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x) if n else [], pa.int64())) for x in (rare, times)]
            made = [
                pa.array(np.arange(row, row + n)),
                *[pa.array(np.concatenate(x)) if n else pa.array([], t) for x, t in ((sizes, pa.int64()), (known, pa.int64()), (base, pa.float64()), (score, pa.float64()))],
                *lists,
            ]
            names = [*batch.schema.names[:-1], "row", "n_tokens", "known", "base", "score", "rare", "times"]
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + made, names=names)

    return task


def fold(id_col: str) -> Column:
    """crc32 of the id as text modulo 5; a null id is in fold 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5, F.lit(0))


def answered(rows: DataFrame, built: DataFrame, shards: int, groups: int) -> DataFrame:
    """The texts in blocks, with the levels of all their keys, by a join with the shards of a filter.

    A block asks once for each of its distinct keys, so a frequent pair is no hot key.
    """
    spark = rows.sparkSession
    lists = "doc_id array<bigint>, held_out array<boolean>, text array<string>"
    blocks = staged(rows.mapInArrow(block_texts, f"block bigint, tuning boolean, {lists}"), scratch_path(spark, "blocks"))
    asked = blocks.select("block", "text").mapInArrow(ask(groups), "group int, block bigint, data binary")
    group = F.col("shard").bitwiseAND(F.lit(groups - 1)).alias("group")
    parts = built.select(group, F.lit(None).cast("bigint").alias("block"), "shard", F.col("bits").alias("data"))
    both = parts.unionByName(asked.withColumn("shard", F.lit(None).cast("int")))
    both = both.repartition("group").sortWithinPartitions("group", F.col("block").asc_nulls_first())
    answers = both.mapInArrow(answer(shards), "block bigint, group int, levels binary")
    answers = answers.groupBy("block").agg(F.collect_list(F.struct("group", "levels")).alias("answers"))
    return staged(blocks.join(answers, "block"), scratch_path(spark, "answered"))


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out_fold: int = 1, tuning_fold: int = 2) -> DataFrame:
    """Scores of each text: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    The model is learned from all texts outside the held-out fold. Words and
    all pairs of a word and its history are counted; their counts, quantised to levels, go into
    a Bloom filter, once for each level, which is built in shards by the tasks.
    Its size follows the number of entries. Up to ``MAX_BYTES`` it is sent to all
    tasks; a larger one stays in its shards and the distinct keys of blocks of
    texts are joined with them, with the same result. A text is scored by probing level after level, and the pair's
    share of its history is interpolated with the word's share; the weight
    depends on the history's level and maximises the likelihood of a
    fifth of the training texts, each token's own occurrence left out.

    The base score is exact: the counts of common words go to the tasks, those
    of all others meet the texts in a join, where no word is frequent.

    A null or empty text is one end token. A table without training texts gives
    ``train_tokens`` 0 and scores by the smoothing alone. Repeated rows count as
    rows of their own. An empty table gives no rows.
    """
    spark = docs.sparkSession
    train = docs.where(fold(id_col) != held_out_fold).select(F.col(text_col).alias("text"))
    counts = train.mapInArrow(count_words, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    counts = staged(counts, scratch_path(spark, "words"))
    begin = int(np.array([BEGIN], np.uint64).view(np.int64)[0])
    real = counts.where(F.col("key") != begin)
    level = 1 + F.floor(F.ln("n") / float(np.log(BASE)) + 1e-9)
    histogram = real.groupBy(level.cast("int").alias("level")).agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect()
    n_tokens, vocabulary = sum(r["n"] for r in histogram), sum(r["words"] for r in histogram)
    mass = float(sum(VALUES[r["level"]] * r["words"] for r in histogram)) + 0.5 * (vocabulary + 1)
    denominator = n_tokens + 0.5 * (vocabulary + 1)
    unseen = float(np.log10(0.5 / denominator))

    head = counts.where(F.col("n") >= COMMON * n_tokens).orderBy("key").toArrow()
    keys = head.column("key").to_numpy().view(np.uint64)
    logs = np.log10((head.column("n").to_numpy() + 0.5) / denominator)
    order = np.argsort(keys)
    common = spark.sparkContext.broadcast((keys[order], logs[order]))

    shards = max(64, 2 ** int(np.ceil(np.log2(max(1, n_tokens / SHARD_TOKENS)))))
    packets = shards if shards <= PACKED_SHARDS else max(PACKED_SHARDS, shards // SHARDS_PACKED)
    kind = "group int, keys binary, counts binary"
    pairs = train.mapInArrow(packed(packets, count_pairs), kind).withColumn("word", F.lit(False))
    grams = pairs.unionByName(counts.mapInArrow(packed(packets), kind).withColumn("word", F.lit(True)))
    grams = grams.repartition("group").sortWithinPartitions("group")
    build, unpack = build_filter(), unpacked(shards)
    built = staged(grams.mapInArrow(lambda batches: build(unpack(batches)), "shard int, bits binary"), scratch_path(spark, "filter"))
    size = built.agg(F.sum(F.octet_length("bits"))).first()[0] or 0

    held_out, tuned = fold(id_col) == held_out_fold, fold(id_col) == tuning_fold
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), held_out.alias("held_out"), tuned.alias("tuning"), F.col(text_col).alias("text"))
    if size <= MAX_BYTES:
        filters = built.toArrow()
        filters = dict(zip(filters.column("shard").to_pylist(), filters.column("bits").to_pylist(), strict=True))
        source = from_filter(spark.sparkContext.broadcast(shard_arrays(filters, shards)))
        del filters
    else:
        groups = min(shards, max(64, 2 ** int(np.ceil(np.log2(size / GROUP_BYTES)))))
        source = from_answers(groups)
        rows = answered(rows, built, shards, groups)

    likelihood = rows.where("tuning").drop("tuning").mapInArrow(tune(source, common, mass), "level bigint, grid bigint, total double")
    table = np.full((LEVELS, len(GRID)), -np.inf)
    for r in likelihood.groupBy("level", "grid").agg(F.sum("total").alias("total")).collect():
        table[r["level"], r["grid"]] = r["total"]
    weights = np.array(GRID)[table.argmax(axis=1)]

    schema = "doc_id bigint, held_out boolean, row bigint, n_tokens bigint, known bigint, base double, score double, rare array<bigint>, times array<bigint>"
    scored = staged(rows.drop("tuning").mapInArrow(score_texts(source, common, weights, mass), schema), scratch_path(spark, "scores"))

    uncommon = counts.where(F.col("n") < COMMON * n_tokens).where(F.col("key") != begin)
    listed = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select("row", F.col("w.rare").alias("key"), "w.times")
    log = F.log10((F.col("n") + 0.5) / F.lit(denominator))
    found = listed.join(uncommon, "key").groupBy("row").agg(F.sum("times").alias("rare_known"), F.sum(F.col("times") * log).alias("rare_base"))
    whole = scored.drop("rare", "times").join(found, "row", "left")
    n_known = F.col("known") + F.coalesce("rare_known", F.lit(0))
    base = F.col("base") + F.coalesce("rare_base", F.lit(0.0)) + (F.col("n_tokens") - n_known) * F.lit(unseen)
    return whole.select(
        "doc_id",
        "held_out",
        "n_tokens",
        n_known.alias("n_known"),
        F.lit(n_tokens).cast("bigint").alias("train_tokens"),
        base.alias("base_score"),
        "score",
    )
