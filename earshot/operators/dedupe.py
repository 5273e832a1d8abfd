"""Removal of duplicates.

Both operators combine on the map side, so a key that holds a large share of the
rows leaves each map task as one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def keep_first(df: DataFrame, key: str | Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key; ``order`` must be a total order within a key.

    Spark plans the rank filter as a ``WindowGroupLimit`` on both sides of the
    exchange. ``dropDuplicates`` would keep an arbitrary row instead.
    """
    keys = [key] if isinstance(key, str) else list(key)
    first = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", first).where(F.col("_rank") == 1).drop("_rank")


def first_values(df: DataFrame, key: str, order: Sequence[Column], values: Sequence[str]) -> DataFrame:
    """Some values of the first row of each key, by an aggregate.

    ``order`` is ascending and total within a key. Tasks sort by the key alone,
    not by the order, so this is faster than ``keep_first`` where keys repeat a
    lot and few columns are wanted.
    """
    places = [c.alias(f"_{i}") for i, c in enumerate(order)]
    first = F.min(F.struct(*places, *values)).alias("_first")
    return df.groupBy(key).agg(first).select(key, *[F.col(f"_first.{v}").alias(v) for v in values])


def distinct_first(df: DataFrame, ordinal: str) -> DataFrame:
    """Distinct rows, each with the ordinal of its first occurrence."""
    values = [c for c in df.columns if c != ordinal]
    return df.groupBy(*values).agg(F.min(ordinal).alias(ordinal))
