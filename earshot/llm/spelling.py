"""Spelling variants: words of a corpus that differ by one edit, found by search schemes on a bidirectional FM-index."""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from earshot.llm.fm_index import WordIndex
from earshot.operators.sizing import scratch_path, staged

# fixed values: what counts as a letter, and the noise
RUN = "[a-zÀ-ÿ]"
NOISE = 199
MIN_LETTERS = 6
MIN_COUNT = 5
MARGIN = 5
"""A form is at least so many times as frequent as its variant."""

BLOCK = 200_000
"""Letters of the words of one index."""
HELD = 200_000
"""Distinct words that a counting task holds before it hands them on."""
QUERIES = 20_000
"""Queries that a task answers together."""


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and their counts, of texts with their ids as text."""
    runs = re.compile(f"{RUN}{{{MIN_LETTERS},}}+")
    total: Counter[str] = Counter()

    def handed_on() -> pa.RecordBatch:
        out = pa.record_batch([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])
        total.clear()
        return out

    for batch in batches:
        for doc_id, text in zip(batch["id"], batch["text"], strict=True):
            # Only A-Z change: bytes know no other letters.
            found = Counter(runs.findall((text.as_py() or "").encode().lower().decode()))
            seed = zlib.crc32(f"{doc_id.as_py() or ''}:".encode())
            for run, n in found.items():
                h = zlib.crc32(run.encode(), seed)
                if h % NOISE == 0:
                    i = h % len(run)
                    run = run[:i] + run[i + 1 :]
                    if len(run) < MIN_LETTERS:
                        continue
                total[run] += n
            if len(total) > HELD:
                yield handed_on()
    yield handed_on()


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word``, ``n``: runs of letters, A-Z lower-cased, of at least six letters, that occur five times or more.

    One occurrence in 199, told by the CRC-32 of id and run, loses a letter, which
    plants misspellings. A null text has no runs; a null id counts as empty. Texts
    and runs may have any length; repeated rows count each time.
    """
    texts = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    counts = texts.mapInArrow(_counted, "word string, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def _blocks(words: DataFrame, tasks: int) -> DataFrame:
    """``s``, ``n`` with ``block``: stretches of the sorted words of a bounded number of letters."""
    ranged = words.repartitionByRange(tasks, "s").withColumn("part", F.spark_partition_id())
    # Staged, as the borders come from a sample.
    ranged = staged(ranged, scratch_path(words.sparkSession, "ranges"))
    before = F.sum(F.length("s")).over(W.partitionBy("part").orderBy("s").rowsBetween(W.unboundedPreceding, -1))
    number = F.floor(F.coalesce(before, F.lit(0)) / BLOCK).cast("bigint")
    return ranged.select("s", "n", (F.shiftleft(F.col("part").cast("bigint"), 32) + number).alias("block"))


def _exact(s: str, mirrored: bool) -> int:
    """Length of the half that is matched exactly: the left half of a word, or the right half of a mirrored one."""
    return len(s) - len(s) // 2 if mirrored else len(s) // 2


def _sent(borders: list[tuple[int, str, str]], mirrored: bool):
    """Send each query to the blocks that can hold words which begin with its exact half."""
    blocks, lows, highs = (list(x) for x in zip(*borders, strict=True))

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, query = [], []
            for s in batch["s"].to_pylist():
                half = s[: _exact(s, mirrored)]
                for k in range(bisect_left(highs, half), bisect_right(lows, half + "\U0010ffff")):
                    block.append(blocks[k])
                    query.append(s)
            yield pa.record_batch([pa.array(block, pa.int64()), pa.array(query, pa.string())], ["block", "s"])

    return send


def _searched(mirrored: bool):
    """Answer the queries of each block; its words come first, in their order, then its queries."""

    def turned(s: str) -> str:
        return s[::-1] if mirrored else s

    def answers(index: WordIndex, counts: list[int], queries: list[str]) -> pa.RecordBatch:
        word, near, n = [], [], []
        exact = [_exact(s, mirrored) for s in queries]
        for q, t in index.near(queries, exact):
            s, other = queries[q], index.words[t]
            # A word that shares both halves with the query was found by its left half already.
            if not (mirrored and other.endswith(s[exact[q] :])):
                word.append(turned(s))
                near.append(turned(other))
                n.append(counts[t])
        return pa.record_batch([pa.array(word, pa.string()), pa.array(near, pa.string()), pa.array(n, pa.int64())], ["word", "near", "near_n"])

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, index, words, counts, queries = None, None, [], [], []
        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("block", "s", "n"))
            for at, s, n in zip(*columns, strict=True):
                if at != block or len(queries) >= QUERIES:
                    if queries:
                        yield answers(index, counts, queries)
                        queries = []
                    if at != block:
                        block, index, words, counts = at, None, [], []
                if n is not None:
                    words.append(s)
                    counts.append(n)
                    continue
                if index is None:
                    index = WordIndex(words)
                queries.append(s)
        if queries:
            yield answers(index, counts, queries)

    return search


def near_words(words: DataFrame) -> DataFrame:
    """``word``, ``near``, ``near_n``: all pairs of words that differ by exactly one edit, in both directions.

    ``words`` (staged, each word once) has ``word`` and ``n``. One edit leaves one
    half of a word as it is: words are indexed in blocks by their order, and again
    by the order of their mirror images, and each word asks the blocks that hold
    its left half, then those that hold its right half. A word is answered by one
    half, so no pair comes twice.
    """
    spark = words.sparkSession
    letters = words.agg(F.sum(F.length("word"))).first()[0] or 0
    tasks = -(-letters // BLOCK) or 1
    out = None
    for mirrored in (False, True):
        turned = words.select((F.reverse("word") if mirrored else F.col("word")).alias("s"), "n")
        blocks = staged(_blocks(turned, tasks), scratch_path(spark, "blocks"))
        # As many borders as there are blocks: letters of the vocabulary by BLOCK.
        borders = blocks.groupBy("block").agg(F.min("s").alias("low"), F.max("s").alias("high")).orderBy("low").collect()
        if not borders:
            continue
        queries = turned.select("s").mapInArrow(_sent([tuple(b) for b in borders], mirrored), "block bigint, s string")
        both = blocks.select("block", "s", "n").unionByName(queries.withColumn("n", F.lit(None).cast("bigint")))
        dealt = both.repartition(2 * len(borders), "block").sortWithinPartitions("block", F.col("n").isNull(), "s")
        found = dealt.mapInArrow(_searched(mirrored), "word string, near string, near_n bigint")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], "word string, near string, near_n bigint")
    return out


def _rooted(forms: DataFrame) -> DataFrame:
    """``word``, ``root``: forms followed to the last, each round twice as far.

    A form has five times its variant's count, so chains are short and have no
    cycle, and a word has no more variants than there are edits of it.
    """
    spark = forms.sparkSession
    chain = forms.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        chain = staged(chain, scratch_path(spark, "roots"))
        further = chain.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = chain.join(further, "root", "left")
        if moved.where("next IS NOT NULL").isEmpty():
            return chain
        chain = moved.select("word", F.coalesce("next", "root").alias("root"))


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each word of the vocabulary, with the form it is a variant of.

    ``word``; ``form``, its most frequent near word (of equals the smallest in
    code-point order) if that is at least five times as frequent, else null;
    ``root``, where forms lead in the end, the word itself if it has none; ``n``
    and ``n_near``, its occurrences and the number of its near words; ``form_n``.

    Null and empty texts add nothing; an empty table gives no rows; repeated rows
    and equal texts count each time; columns other than id and text are not looked
    at. Jobs run while the plan is built.
    """
    spark = docs.sparkSession
    words = staged(vocabulary(docs, id_col, text_col), scratch_path(spark, "words"))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best")
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best)
    joined = words.join(near, "word", "left")
    strong = -F.col("best.less") >= MARGIN * F.col("n")

    def if_strong(value: Column) -> Column:
        return F.when(strong, value)

    forms = joined.select(
        "word",
        if_strong(F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        if_strong(-F.col("best.less")).alias("form_n"),
    )
    forms = staged(forms, scratch_path(spark, "forms"))
    rooted = forms.join(_rooted(forms), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
