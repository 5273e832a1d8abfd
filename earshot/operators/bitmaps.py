"""Exact distinct counts over any range of days, from one bitmap per day.

Users get dense numbers once. A day's users are a set of bits, in buckets of
32,768 numbers (4 KB); the users of a range are the union of its days' bitmaps,
so a count over a week or a year reads small tables and never the fact again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from earshot.operators.sizing import broadcast_within, measured, scratch_path, staged


def dense_numbers(df: DataFrame, column: str, known: DataFrame | None = None, path: str | None = None) -> DataFrame:
    """``column`` and ``number``: a number for each distinct value, without gaps, in a table at ``path`` (scratch by default).

    ``known``, an earlier result, keeps its numbers; new values go on after them.
    Each partition numbers its values and starts from the sizes of those before
    it. Nulls have no number.
    """
    spark = df.sparkSession
    fresh = df.select(column).where(F.col(column).isNotNull()).distinct()
    start = 1  # Spark puts number 0 into a bucket of its own
    if known is not None:
        fresh = fresh.join(known.select(column), column, "left_anti")
        start = (known.agg(F.max("number")).first()[0] + 1) if not known.isEmpty() else 1
    cut = staged(fresh.withColumn("part", F.spark_partition_id()), scratch_path(spark, "values"))
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    sizes = cut.groupBy("part").agg(F.count("*").alias("size"))  # as many rows as tasks
    starts, n = measured(sizes.select("part", (F.coalesce(F.sum("size").over(earlier), F.lit(0)) + start).alias("start")))
    within = F.row_number().over(W.partitionBy("part").orderBy(column)) - 1
    numbered = cut.withColumn("place", within).join(broadcast_within(starts, n), "part")
    numbers = numbered.select(column, (F.col("start") + F.col("place")).cast("bigint").alias("number"))
    if known is not None:
        numbers = known.select(column, "number").unionByName(numbers)
    return staged(numbers, path or scratch_path(spark, "numbers"))


def day_bitmaps(rows: DataFrame, numbers: DataFrame, column: str, date: str) -> DataFrame:
    """``date``, ``bucket``, ``bitmap``: who was there on a day. Pairs of day and value combine before they are shuffled."""
    pairs = rows.select(date, column).where(F.col(date).isNotNull()).distinct()
    numbered = pairs.join(numbers, column)
    bucket, bit = F.bitmap_bucket_number("number").alias("bucket"), F.bitmap_bit_position("number")
    return numbered.groupBy(F.col(date).alias("date"), bucket).agg(F.bitmap_construct_agg(bit).alias("bitmap"))


def distinct_between(bitmaps: DataFrame, first, last) -> DataFrame:
    """One row ``n``: distinct values from the day ``first`` to the day ``last``, both included."""
    days = bitmaps.where(F.col("date").between(F.lit(first), F.lit(last)))
    merged = days.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.agg(F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).alias("n"))


def distinct_rolling(bitmaps: DataFrame, days: int) -> DataFrame:
    """``date``, ``n``: for each day that has a bitmap, the distinct values of the ``days`` days that end with it."""
    ends = F.explode(F.sequence(F.lit(0), F.lit(days - 1))).alias("later")
    spread = bitmaps.select("date", "bucket", "bitmap", ends)
    merged = spread.groupBy(F.date_add("date", F.col("later")).alias("date"), "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    counted = merged.groupBy("date").agg(F.sum(F.bitmap_count("bitmap")).alias("n"))
    return counted.join(bitmaps.select("date").distinct(), "date", "left_semi")
