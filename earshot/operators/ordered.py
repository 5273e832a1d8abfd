"""Row numbers and lags within a key, for keys of any size.

A plain window brings all rows of a key into one task. The functions here first
measure which keys exceed ``max_rows`` (an aggregate over the key column alone,
run while the plan is built). If there are none, the plain window is what runs.
A heavier key is cut into slices of even size that are numbered in parallel, and
each slice starts from the number of rows in the slices before it. A task cuts
many slices if they are small, so the tasks follow the rows and not the slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from earshot.operators.sizing import broadcast_within, measured, scratch_path, staged

MAX_ROWS = 10_000_000
"""Rows of one key that a single task sorts without trouble."""
TASK_ROWS = 250_000
"""Rows that a task cuts into slices, where these are smaller."""


def heavy_keys(df: DataFrame, key: str, max_rows: int = MAX_ROWS) -> tuple[DataFrame, int]:
    """Keys with more than ``max_rows`` rows, and these rows: at most the row total divided by it."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    return measured(counts.where(F.col("_rows") > max_rows).select(F.col(key).alias("_heavy"), "_rows"))


def _tasks(heavy: DataFrame, max_rows: int) -> int:
    """So many tasks that one cuts ``TASK_ROWS`` rows, or a slice if that is more; all cores have some, if there are slices enough."""
    total = heavy.agg(F.sum("_rows")).first()[0]
    slices = -(-total // _slice_rows(max_rows))
    return min(slices, max(heavy.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_ROWS)))


def _slice_rows(max_rows: int) -> int:
    """Rows of a slice: half of ``max_rows``."""
    return max(1, max_rows // 2)


def _in(df: DataFrame, key: str, heavy: DataFrame, n: int, how: str) -> DataFrame:
    return df.join(broadcast_within(heavy.select("_heavy"), n), F.col(key).eqNullSafe(F.col("_heavy")), how)


def _order(columns: list[str], newest_first: bool) -> list[Column]:
    time, *ties = columns
    head = F.desc_nulls_last(time) if newest_first else F.asc_nulls_first(time)
    return [head, *[F.asc(t) for t in ties]]


def _cut(df: DataFrame, key: str, order: list[Column], tasks: int, size: int) -> DataFrame:
    """The rows with ``_slice``, which grows in the order of key, time and ties and holds ``size`` rows at most.

    Each task sorts the rows between two sampled quantiles and cuts them by their
    places. The ties make the order total, so a second or a null time with very
    many rows is cut as well. The slices are staged, as their borders come from a
    sample.
    """
    place = F.monotonically_increasing_id()
    by_key = [F.asc(key), *order]
    ranged = df.repartitionByRange(tasks, *by_key).sortWithinPartitions(*by_key).withColumn("_place", place)
    sliced = ranged.withColumn("_slice", F.col("_place") - F.col("_place") % size).drop("_place")
    return staged(sliced, scratch_path(df.sparkSession, "slices"))


def _same_slice(key: str) -> Column:
    return F.col(key).eqNullSafe(F.col("_key")) & (F.col("_slice") == F.col("_part"))


def _reversed(columns: list[str]) -> list[Column]:
    time, *ties = columns
    return [F.desc_nulls_last(time), *[F.desc(t) for t in ties]]


def _number_slices(
    df: DataFrame, key: str, time: str, ties: list[str], newest_first: bool, out: str, tasks: int, size: int
) -> DataFrame:
    """Row numbers by slices of even size. Null keys count as a key."""
    order = _order([time, *ties], newest_first)
    sliced = _cut(df, key, order, tasks, size)
    local = sliced.withColumn("_local", F.row_number().over(W.partitionBy(key, "_slice").orderBy(*order)))

    earlier = W.partitionBy("_key").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    sizes = sliced.groupBy(F.col(key).alias("_key"), F.col("_slice").alias("_part"))
    starts = (
        sizes.agg(F.count(F.lit(1)).alias("_size"))
        .withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
        .drop("_size")
    )
    return local.join(starts, _same_slice(key)).select(*df.columns, (F.col("_before") + F.col("_local")).alias(out))


def _lag_slices(
    df: DataFrame, key: str, time: str, ties: list[str], value: str, offset: int, out: str, tasks: int, size: int
) -> DataFrame:
    """Lags by slices: each slice gets the last ``offset`` values of the slices before it, and lags within itself.

    A slice has a row of its key at least, so the last ``offset`` slices hold
    them. What is carried is a few values for each slice, however long it is.
    """
    order = _order([time, *ties], False)
    sliced = _cut(df, key, order, tasks, size)
    within = W.partitionBy(key, "_slice").orderBy(*order)
    last = F.row_number().over(W.partitionBy(key, "_slice").orderBy(*_reversed([time, *ties])))
    # Values are wrapped, as an array of them would lose nulls.
    wrapped = F.struct((-F.col("_from_end")).alias("place"), F.col(value).alias("v"))
    ends = sliced.withColumn("_from_end", last).where(F.col("_from_end") <= offset)
    ends = ends.groupBy(F.col(key).alias("_key"), F.col("_slice").alias("_part")).agg(F.array_sort(F.collect_list(wrapped)).alias("_ends"))
    earlier = W.partitionBy("_key").orderBy("_part").rowsBetween(-offset, -1)
    carried = ends.select("_key", "_part", F.flatten(F.collect_list("_ends").over(earlier)).alias("_carried"))
    first = F.greatest(F.size("_carried") - (offset - 1), F.lit(1))
    carries, n = measured(carried.withColumn("_carried", F.slice("_carried", first, offset)))
    numbered = sliced.withColumn("_local", F.row_number().over(within)).withColumn("_near", F.lag(value, offset).over(within))
    joined = numbered.join(broadcast_within(carries, n), _same_slice(key))
    # Row 1 looks ``offset`` values back into what is carried, row ``offset`` one.
    place = F.size("_carried") - (offset - F.col("_local")) - 1
    far = F.when(place >= 0, F.get("_carried", place)["v"])
    return joined.select(*df.columns, F.when(F.col("_local") > offset, F.col("_near")).otherwise(far).alias(out))


def row_numbers(
    df: DataFrame,
    key: str,
    time: str,
    ties: list[str],
    out: str,
    newest_first: bool = False,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY key ORDER BY time, ties)`` as BIGINT.

    ``ties`` must make the order total. To keep only the first row per key use
    ``keep_first``, which needs no measuring.
    """
    heavy, n = heavy_keys(df, key, max_rows)
    window = W.partitionBy(key).orderBy(*_order([time, *ties], newest_first))
    plain = F.row_number().over(window).cast("bigint")
    if n == 0:
        return df.withColumn(out, plain)
    light = _in(df, key, heavy, n, "left_anti").withColumn(out, plain)
    rows = _in(df, key, heavy, n, "left_semi")
    cut = _number_slices(rows, key, time, ties, newest_first, out, _tasks(heavy, max_rows), _slice_rows(max_rows))
    return light.unionByName(cut)


def lagged(
    df: DataFrame,
    key: str,
    time: str,
    ties: list[str],
    value: str,
    offset: int,
    out: str,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """``LAG(value, offset) OVER (PARTITION BY key ORDER BY time, ties)``.

    Slices of a heavy key take the last values of the slices before them along.
    """
    heavy, n = heavy_keys(df, key, max_rows)
    plain = F.lag(value, offset).over(W.partitionBy(key).orderBy(*_order([time, *ties], False)))
    if n == 0:
        return df.withColumn(out, plain)
    light = _in(df, key, heavy, n, "left_anti").withColumn(out, plain)
    rows = _in(df, key, heavy, n, "left_semi")
    cut = _lag_slices(rows, key, time, ties, value, offset, out, _tasks(heavy, max_rows), _slice_rows(max_rows))
    return light.unionByName(cut)
