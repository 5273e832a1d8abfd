"""Counts per group, attached to rows or not, and shares of a total."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.operators.sizing import broadcast_within, measured, scratch_path, staged


def group_count(df: DataFrame, keys: str | Sequence[str], counted: str, out: str) -> DataFrame:
    """Number of non-null ``counted`` values per group."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(counted).alias(out))


def with_group_count(df: DataFrame, keys: str | Sequence[str], counted: str, out: str, stage: bool = False) -> DataFrame:
    """Every row with the count of its group: ``COUNT(x) OVER (PARTITION BY keys)``.

    A window would bring each group into one task. Counts combine on the map
    side, and the one row per group is joined back: by broadcast when the
    measured number of groups allows, else by a shuffle whose skew Spark splits
    at run time. The counts are computed while the plan is built; ``stage``
    writes an input that is dear to compute to the shared folder first, as it is
    read for the counts and for the rows.
    """
    if stage:
        df = staged(df, scratch_path(df.sparkSession, "grouped"))
    keys = [keys] if isinstance(keys, str) else list(keys)
    counts, n = measured(group_count(df, keys, counted, out))
    counts = counts.withColumnsRenamed({k: f"_group_{k}" for k in keys})
    same_group = [F.col(k).eqNullSafe(F.col(f"_group_{k}")) for k in keys]
    joined = df.join(broadcast_within(counts, n), same_group)
    return joined.select(*df.columns, out)


def percent_of(count: Column, total: DataFrame) -> Column:
    """``count`` as a percentage of the single value of ``total``."""
    return count / total.scalar() * F.lit(100)


def distinct_total(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    """One row with the number of distinct values; exact unless asked otherwise."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(count(column).alias("n"))
