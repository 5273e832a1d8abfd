"""Benchmark decontamination: rare word n-grams seed Smith-Waterman alignments of documents with test items."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.llm.text import set_aside
from earshot.llm.words import ngram_hashes, text_words

SEED = 3
"""Words of a seed."""
MIN_ITEM = 5
"""Fewest words of an item that is searched for in texts; shorter ones occur by chance and are compared with whole texts."""
RARE = 1e-6
"""Chance of an n-gram, by the frequencies of its words, up to which it is rare."""
LEAST_SEEDS = 8
"""So many of an item's n-grams are seeds in any case, the rarest first."""
SLACK = 0.3
"""Room for insertions around a seed's diagonal, as a share of the item."""
MIN_SCORE = 0.5
"""Alignment score, as a share of a full match, from which a passage is a copy."""
LEAST_SCORE = 8
"""Least score of a copy; items of up to so many words must match in full."""
BLOCK_WORDS = 500_000
"""Words of test items that are sent to all tasks at once; more items make more passes."""
FILTER_BITS = 20

MATCH = T.StructType(
    [
        T.StructField("item_id", T.LongType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
    ]
)
ARROW_MATCH = pa.list_(
    pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("start", pa.int64()), ("end", pa.int64())])
)


def count_vocabulary(vocabulary: np.ndarray, text_at: str) -> Callable:
    """Counts of the words of a sorted vocabulary, one row for each word and batch; the null word counts all."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, total = np.zeros(len(vocabulary), np.int64), 0
        for batch in batches:
            for _, words, _ in text_words(batch.column(text_at)):
                total += len(words)
                place = np.searchsorted(vocabulary, words)
                place[place == len(vocabulary)] = 0
                hit = vocabulary[place] == words
                counts += np.bincount(place[hit], minlength=len(vocabulary))
        seen = np.flatnonzero(counts)
        words = pa.array([*vocabulary[seen].view(np.int64).tolist(), None], pa.int64())
        yield pa.RecordBatch.from_arrays([words, pa.array([*counts[seen].tolist(), total], pa.int64())], names=["word", "n"])

    return task


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Smith-Waterman over words: best score, and where it begins and ends in the passage.

    A match counts 1, a mismatch or a gap -1. Each row is filled at once: a gap
    along the row is a running maximum after adding the position. The begin of
    each best path is carried along.
    """
    n = len(passage)
    place = np.arange(n + 1)
    score, begin = np.zeros(n + 1, np.int64), place.copy()
    best = (0, 0, 0)
    for word in item:
        step = np.where(passage == word, 1, -1)
        diagonal = score[:-1] + step
        upward = score[1:] - 1
        cell = np.maximum(diagonal, upward)
        start = np.where(diagonal >= upward, begin[:-1], begin[1:])
        fresh = cell <= 0
        cell = np.append(0, np.where(fresh, 0, cell))
        start = np.append(0, np.where(fresh, place[1:], start))
        raised = cell + place
        top = np.maximum.accumulate(raised)
        origin = np.maximum.accumulate(np.where(raised == top, place, 0))
        score, begin = top - place, start[origin]
        at = int(score.argmax())
        if score[at] > best[0]:
            best = (int(score[at]), int(begin[at]), at)
    return best


def least_score(n: int) -> float:
    """The score from which a passage is a copy of an item of ``n`` words."""
    return max(MIN_SCORE * n, min(n, LEAST_SCORE))


def copies(item: np.ndarray, passage: np.ndarray) -> list[tuple[int, int, int]]:
    """The best copy of an item in a passage, and those on both sides of it."""
    found, parts = [], [(0, len(passage))]
    while parts:
        low, high = parts.pop()
        if high - low < least_score(len(item)):
            continue
        score, first, last = align(item, passage[low:high])
        if score >= least_score(len(item)):
            found.append((score, low + first, low + last))
            parts += [(low, low + first), (low + last, high)]
    return sorted(found, key=lambda x: x[1])


def seed_table(items: list[tuple[int, np.ndarray]], rank: dict[int, float]) -> tuple:
    """A block of test items, and its seeds sorted by hash: hash, item, place in the item."""
    hashes, owners, places, short = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], {}
    for k, (item_id, words) in enumerate(items):
        if len(words) < MIN_ITEM:
            short.setdefault(words.tobytes(), []).append(item_id)
            continue
        grams = ngram_hashes(words, SEED)
        chance = np.array([rank.get(int(w), 0.0) for w in words.view(np.int64)])
        chance = np.prod([chance[i : i + len(grams)] for i in range(SEED)], axis=0)
        order = np.argsort(chance, kind="stable")
        seeds = order[: max(LEAST_SEEDS, int((chance <= RARE).sum()))]
        hashes.append(grams[seeds])
        owners.append(np.full(len(seeds), k))
        places.append(seeds)
    joined = np.concatenate(hashes)
    order = np.argsort(joined, kind="stable")
    return items, joined[order], np.concatenate(owners)[order], np.concatenate(places)[order], short


def seed_filter(seeds: np.ndarray) -> np.ndarray:
    table = np.zeros(1 << FILTER_BITS, bool)
    table[seeds & np.uint64((1 << FILTER_BITS) - 1)] = True
    return table


def matches(table: tuple, maybe: np.ndarray, words: np.ndarray) -> list[dict]:
    """The items of a seed table that a text holds."""
    items, seeds, owner_of, place_of, short = table
    if len(words) < MIN_ITEM:
        return [{"item_id": k, "score": 1.0, "start": 0, "end": len(words)} for k in short.get(words.tobytes(), ())]
    grams = ngram_hashes(words, SEED)
    at = np.flatnonzero(maybe[grams & np.uint64((1 << FILTER_BITS) - 1)])
    if not len(at):
        return []
    low = np.searchsorted(seeds, grams[at], side="left")
    counts = np.searchsorted(seeds, grams[at], side="right") - low
    if not counts.any():
        return []
    runs = np.repeat(low, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    owners, diagonals = owner_of[runs], np.repeat(at, counts) - place_of[runs]
    found = []
    for owner in np.unique(owners):
        item_id, item = items[owner]
        slack = int(SLACK * len(item)) + 2
        line = np.unique(diagonals[owners == owner])
        cuts = np.flatnonzero(np.diff(line) > len(item) + 2 * slack) + 1
        for part in np.split(line, cuts):
            begin = max(0, int(part[0]) - slack)
            for score, first, last in copies(item, words[begin : int(part[-1]) + len(item) + slack]):
                found.append({"item_id": item_id, "score": score / len(item), "start": begin + first, "end": begin + last})
    return found


def search(shared, text_at: str) -> Callable:
    """Append the matches of each text with the items of a block to the column ``matches``."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        maybe = seed_filter(table[1])
        for batch in batches:
            found = [
                matches(table, maybe, words[low:high])
                for _, words, edges in text_words(batch.column(text_at))
                for low, high in zip(edges[:-1], edges[1:], strict=True)
            ]
            before = batch.column("matches").to_pylist()
            both = pa.array([a + b for a, b in zip(before, found, strict=True)], ARROW_MATCH)
            place = batch.schema.get_field_index("matches")
            yield batch.set_column(place, "matches", both)

    return task


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[int, np.ndarray]]]:
    """The items, hashed, in blocks of bounded size; they pass the driver one by one."""
    block, size = [], 0
    for item_id, text in benchmark.select(F.col(item_col).cast("bigint"), text_col).orderBy(item_col, text_col).toLocalIterator():
        for _, words, _ in text_words(pa.array([text], pa.string())):
            if not len(words):
                continue
            if block and size + len(words) > BLOCK_WORDS:
                yield block
                block, size = [], 0
            block.append((item_id, words))
            size += len(words)
    if block:
        yield block


def benchmark_matches(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``docs`` with ``matches``: the test items a text holds, each with its score and word positions.

    Words are lower-cased (A-Z). The frequencies of the items' words over all
    documents tell which of their word triples are rare; a rare triple of an item in a text
    (or one of the rarest eight of the item) seeds an alignment of the item with
    the passage around it, with room for insertions. A passage is a match if the
    Smith-Waterman score reaches half of a full match and eight words, or all words of a shorter item, so edited copies of longer ones count. A
    copied passage makes its own triples frequent, so rarity is judged by the single words.

    Items go to the tasks in blocks of bounded size, each in one pass over
    ``docs`` without a shuffle. Items of fewer than five words match texts of
    just these words; null items and null or empty texts match nothing; repeated rows get equal results; a column
    ``matches`` of ``docs`` is replaced. The word counts are taken while the plan is built.
    """
    spark = docs.sparkSession
    out = docs.withColumn("matches", F.array().cast(T.ArrayType(MATCH)))
    schema = out.schema
    for block in item_blocks(benchmark, item_col, item_text):
        vocabulary = np.unique(np.concatenate([words for _, words in block]))
        counted = docs.select(text_col).mapInArrow(count_vocabulary(vocabulary, text_col), "word bigint, n bigint")
        counts = dict(counted.groupBy("word").agg(F.sum("n")).collect())  # at most one row for each word of the block
        total = counts.pop(None, 0) or 1
        table = seed_table(block, {word: n / total for word, n in counts.items()})
        out = out.mapInArrow(search(spark.sparkContext.broadcast(table), text_col), schema)
    return out


def leaked_pairs(matched: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row for each match: document, item, score, first word and the word after the last."""
    return matched.select(id_col, F.explode("matches").alias("m")).select(id_col, "m.*")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that hold no test item, their columns unchanged.

    A null or empty text holds none; repeated rows go or stay together; an empty
    table gives no rows, and without items all documents stay.
    """

    def clean(docs: DataFrame) -> DataFrame:
        return benchmark_matches(docs, benchmark, text_col).where(F.size("matches") == 0).drop("matches")

    return set_aside(docs, clean, [text_col], ["matches"])
