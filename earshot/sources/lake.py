"""The event lake as batch tables: layout, compaction and catalog entry.

The stream's folder is governed by the log of its file sink, so nothing else
writes there. Analysts use the compacted table, which is written from it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot import schemas as S
from earshot.operators.dedupe import keep_first
from earshot.operators.sizing import discard, measured, scratch_path, staged
from earshot.operators.upsert import append_by_name, new_rows
from earshot.sources.id_filters import IDENTITY, IdFilters

LAKE_TABLE = T.StructType(
    [*S.LAKE_EVENT.fields, *[T.StructField(k, T.IntegerType()) for k in S.PARTITION_KEYS]]
)


def by_hour(df: DataFrame) -> DataFrame:
    """Gather the rows of an hour for writing.

    The rebalance brings an hour into few files, and at run time splits an hour
    that is too large for one.
    """
    return df.hint("rebalance", *S.PARTITION_KEYS)


def write_partitioned(df: DataFrame, path: str, mode: str = "append") -> None:
    """Write as Snappy Parquet by year, month, day and hour."""
    writer = by_hour(df).write.mode(mode).partitionBy(*S.PARTITION_KEYS)
    writer.option("compression", "snappy").parquet(path)


def read_lake(spark: SparkSession, path: str) -> DataFrame:
    """The lake, with filters on the partition keys pruning its folders."""
    return spark.read.schema(LAKE_TABLE).parquet(path)


def dedupe_events(events: DataFrame) -> DataFrame:
    """One row per ``event_uuid``, the earliest. Events without an id are no repeats of each other and all stay."""
    alone = F.when(F.col("event_uuid").isNull(), F.monotonically_increasing_id())
    kept = keep_first(events.withColumn("_alone", alone), ["event_uuid", "_alone"], ["created_at", "event_name"])
    return kept.drop("_alone")


def with_identity(events: DataFrame) -> DataFrame:
    """Add what makes an event the same: its id, or all its columns where it has none."""
    whole = F.sha2(F.to_json(F.struct(*LAKE_TABLE.names)), 256)
    return events.withColumn(IDENTITY, F.coalesce("event_uuid", F.concat(F.lit("\0"), whole)))


def create_lake_table(spark: SparkSession, table: str, path: str) -> None:
    """Create the external table over ``path`` if absent."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({S.ddl(LAKE_TABLE)}) USING parquet "
        f"OPTIONS (compression 'snappy') PARTITIONED BY ({', '.join(S.PARTITION_KEYS)}) LOCATION '{path}'"
    )


def register_lake(spark: SparkSession, table: str, path: str, written: DataFrame | None = None) -> int:
    """Create the table over data that is there, and pick up its partitions.

    ``written``, what a run wrote (or the partition keys of it), adds only the
    partitions found there, however many folders the table has; without it all
    folders are listed. Returns the number of partitions added.
    """
    create_lake_table(spark, table, path)
    if written is None:
        before = spark.sql(f"SHOW PARTITIONS {table}").count()
        spark.catalog.recoverPartitions(table)
        return spark.sql(f"SHOW PARTITIONS {table}").count() - before
    # As many rows as hours that the run wrote to; an hour that is known takes one look-up by name.
    added = 0
    for row in written.select(*S.PARTITION_KEYS).distinct().collect():
        spec = ", ".join(f"{k}={row[k]}" for k in S.PARTITION_KEYS)
        if spark.sql(f"SHOW PARTITIONS {table} PARTITION ({spec})").isEmpty():
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec})")
            added += 1
    return added


def _hour(row) -> Column:
    """An hour as one number, of its columns or of a row's values."""
    year, month, day, hour = (row[k] for k in S.PARTITION_KEYS)
    return ((year * 100 + month) * 100 + day) * 100 + hour


def stored_ids(spark: SparkSession, table: str, hours: list[int]) -> DataFrame:
    """The ids that some hours of the table hold; other folders are not read."""
    columns = {k: F.col(k) for k in S.PARTITION_KEYS}
    return with_identity(spark.table(table).where(_hour(columns).isin(hours))).select(*S.PARTITION_KEYS, IDENTITY)


def compact(
    spark: SparkSession,
    lake: str,
    target: str,
    table: str,
    where: Column | str | None = None,
    filters: str | None = None,
) -> int:
    """Append the lake's new events, without repeats, to the table at ``target``.

    ``where`` restricts the part of the lake to take in, such as the hours since
    the last run; an event is a repeat wherever in the table its id stands. The
    folder ``filters`` (by default ``target`` with ``-ids`` at its end) holds Bloom
    filters of the ids of each hour; ids are read only of hours that may have one
    of the batch, or whose rows the filters do not account for (these get theirs
    now). Returns the number of events appended; running it again appends nothing.
    Events without an id are the same if all their columns agree. One run at a
    time; a run that was cut short is completed by the next.
    """
    create_lake_table(spark, table, target)
    known = IdFilters(spark, filters or f"{target.rstrip('/')}-ids", S.PARTITION_KEYS)
    events = read_lake(spark, lake)
    if where is not None:
        events = events.where(where)
    events = with_identity(events.select(*LAKE_TABLE.names))
    single = keep_first(events, IDENTITY, ["created_at", "event_name"])
    scratch = scratch_path(spark, "compaction")
    try:
        # Counted first: a small batch is sent to the table instead of shuffling all its ids.
        batch = staged(single, f"{scratch}/batch")
        n = batch.count()
        rows = spark.table(table).groupBy(*S.PARTITION_KEYS).agg(F.count("*").alias("rows"))  # of the files' footers
        off, n_off = measured(known.untrusted(rows))
        if n_off:
            # A layer and a record of the difference make up for what the records lack.
            hours = [_hour(r) for r in off.collect()]
            layer = known.add(staged(stored_ids(spark, table, hours), f"{scratch}/unknown"))
            made_up = off.join(layer.drop("n"), S.PARTITION_KEYS, "left").fillna(1, ["words"])
            known.finish(made_up.select(*S.PARTITION_KEYS, F.col("off").alias("n"), "words"))
        hits = known.candidates(batch, n).select(*S.PARTITION_KEYS).distinct().collect()
        stored = stored_ids(spark, table, [_hour(r) for r in hits]).drop(*S.PARTITION_KEYS)
        fresh = staged(new_rows(batch, stored, [IDENTITY], batch_rows=n), f"{scratch}/fresh")
        appended = fresh.count()
        if appended:
            record = known.add(fresh.select(*S.PARTITION_KEYS, IDENTITY))
            append_by_name(by_hour(fresh), table)
            known.finish(record)
    finally:
        discard(spark, scratch)
    return appended
