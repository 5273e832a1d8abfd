"""Stored Bloom filters of the ids in each partition of a table.

A filter is a table of 64-bit words. An id sets four bits in one word of either
half of its partition's filter, so filters are built by ``bit_or`` and asked by a
join on the word, and take about three bytes for an id of any length. Each run
that appends to the table adds a layer with the ids of its rows and then a record
of how many rows they are. A partition whose records do not add up to its rows
(rows of others, a run that was cut short) is not trusted: its ids are read.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.operators.sizing import broadcast_within, exists, measured

BITS_PER_ID = 12
"""Bits of either half for an id: two in 10,000 unknown ids pass both."""
BITS_SET = 4
HALVES = (0, 1)
IDENTITY = "_identity"


@dataclass(frozen=True)
class IdFilters:
    """The filters of one table, in a folder beside it; ``keys`` are its partition columns."""

    spark: SparkSession
    path: str
    keys: Sequence[str]

    def _schema(self, *more: str) -> str:
        return ", ".join([*[f"{k} int" for k in self.keys], *more])

    def layers(self) -> DataFrame:
        """Words of all layers: partition, layer, its size in words, half, number of the word, its bits."""
        return self._read("layers", "layer string", "words bigint", "half int", "word bigint", "bits bigint")

    def records(self) -> DataFrame:
        """What each finished run appended: partition, rows, and the size of its layer."""
        return self._read("records", "n bigint", "words bigint")

    def _read(self, name: str, *more: str) -> DataFrame:
        schema, path = self._schema(*more), f"{self.path}/{name}"
        return self.spark.read.schema(schema).parquet(path) if exists(self.spark, path) else self.spark.createDataFrame([], schema)

    def add(self, ids: DataFrame) -> DataFrame:
        """Store a layer with ``ids`` (keys and ``_identity``, staged); returns the record for ``finish``."""
        size = F.greatest(F.lit(1.0), F.col("n") * BITS_PER_ID / 64)
        counts = ids.groupBy(*self.keys).agg(F.count("*").alias("n"))
        counts, n = measured(counts.withColumn("words", F.pow(F.lit(2.0), F.ceil(F.log2(size))).cast("bigint")))
        sized = ids.join(broadcast_within(counts.drop("n"), n), list(self.keys))
        halves = sized.withColumn("half", F.explode(F.array(*[F.lit(h) for h in HALVES])))
        marked = halves.select(*self.keys, "words", "half", *_place(F.col(IDENTITY), F.col("half"), F.col("words")))
        layer = marked.groupBy(*self.keys, "words", "half", "word").agg(F.bit_or("mask").alias("bits"))
        layer.withColumn("layer", F.lit(uuid.uuid4().hex)).write.mode("append").parquet(f"{self.path}/layers")
        return counts.select(*self.keys, "n", "words")

    def finish(self, record: DataFrame) -> None:
        """Record that the rows of a layer are in the table. Before this, the layer only adds candidates."""
        record.coalesce(1).write.mode("append").parquet(f"{self.path}/records")

    def untrusted(self, rows: DataFrame) -> DataFrame:
        """Partitions whose rows the records do not account for, with the difference; ``rows`` has keys and ``rows``."""
        known = self.records().groupBy(*self.keys).agg(F.sum("n").alias("known"))
        off = F.coalesce("rows", F.lit(0)) - F.coalesce("known", F.lit(0))
        return rows.join(known, list(self.keys), "full").select(*self.keys, off.alias("off")).where("off <> 0")

    def candidates(self, ids: DataFrame, n: int) -> DataFrame:
        """Partitions that may hold an id, with the id; ``ids`` are ``n`` staged values of ``_identity``."""
        sizes = [r.words for r in self.records().select("words").distinct().collect()]  # powers of two
        if not sizes:
            return self.spark.createDataFrame([], self._schema(f"{IDENTITY} string"))
        asked = ids.select(IDENTITY, F.explode(F.array(*[F.lit(s).cast("bigint") for s in sizes])).alias("words"))
        found = None
        for half in HALVES:
            layers = self.layers().where(F.col("half") == half).drop("half")
            if found is None:
                probes = asked.select("*", *_place(F.col(IDENTITY), F.lit(half), F.col("words")))
                joined = layers.join(broadcast_within(probes, n * len(sizes)), ["words", "word"])
            else:
                probes = found.select("*", *_place(F.col(IDENTITY), F.lit(half), F.col("words")))
                joined = layers.join(probes, [*self.keys, "layer", "words", "word"])
            hit = joined.where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
            found = hit.select(*self.keys, "layer", "words", IDENTITY)
        return found.select(*self.keys, IDENTITY).distinct()


def _place(identity: Column, half: Column, words: Column) -> tuple[Column, Column]:
    """The word of an id in a filter half, and the bits that it sets there."""
    h = F.xxhash64(identity, half)
    bits = [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(BITS_SET)]
    mask = bits[0]
    for b in bits[1:]:
        mask = mask.bitwiseOR(b)
    return F.shiftrightunsigned(h, 6 * BITS_SET).bitwiseAND(words - 1).alias("word"), mask.alias("mask")
