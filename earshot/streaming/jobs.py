"""The stream: read events, enrich, write the lake and the errors.

The lake and the errors are two queries on the same source, each with its own
checkpoint and the exactly-once file sink. The events are parsed twice, which
costs less than giving up exactly-once with one ``foreachBatch``.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from earshot import schemas as S
from earshot.operators.sizing import discard, scratch_path
from earshot.sources.lake import compact, write_partitioned
from earshot.streaming.enrich import REASON, REASONS, decode_envelopes, enrich_events, lake_columns, rejected_events

BUFFER_INTERVAL = "300 seconds"
BUFFER_BYTES = 5 << 20
REPLAY_WINDOW = "24 hours"
SLOT = "_slot"
WRITTEN, REJECTED, OTHER = "written", "rejected", "another reason"


def read_events(
    spark: SparkSession,
    format: str,
    path: str | None = None,
    schema: T.StructType | str | None = None,
    buffer_bytes: int | None = None,
    start: datetime | None = None,
    **options: str,
) -> DataFrame:
    """Open an event stream.

    ``format`` is any streaming source: ``text`` files of JSON lines, ``kafka``,
    or a connector that is installed. Rate limits (``maxFilesPerTrigger``,
    ``maxBytesPerTrigger``, ``maxOffsetsPerTrigger``) and the starting offset are
    options of the source. ``buffer_bytes`` (such as ``BUFFER_BYTES``) limits what a trigger takes
    from a file source; ``start`` lets a Kafka stream begin at that time, as far back as
    the topic reaches. Kafka values are turned into text.
    """
    if buffer_bytes is not None:
        options["maxBytesPerTrigger"] = str(buffer_bytes)
    if start is not None:
        if format != "kafka":
            raise ValueError(f"a start time needs a source with a log of its own, not {format!r}")
        options["startingTimestamp"] = str(int(start.timestamp() * 1000))
    reader = spark.readStream.format(format).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    stream = reader.load(path) if path else reader.load()
    if format == "kafka":
        stream = stream.withColumn("value", F.col("value").cast("string"))
    return stream


def dedupe_stream(enriched: DataFrame, window: str = REPLAY_WINDOW) -> DataFrame:
    """Drop repeats of an ``event_uuid`` that arrive within ``window`` of the first one.

    The watermark is on the time of arrival, which never runs backwards: it bounds
    the state, and no event is late, however old it is. Later repeats pass and
    are removed when the lake is compacted. Events without an id can be no
    repeats; they go around the state, at the price of reading the source twice.
    """
    named = enriched.where(F.col("event_uuid").isNotNull()).withColumn("_arrived", F.current_timestamp())
    single = named.withWatermark("_arrived", window).dropDuplicatesWithinWatermark(["event_uuid"])
    return single.drop("_arrived").unionByName(enriched.where(F.col("event_uuid").isNull()))


def with_slot(events: DataFrame) -> DataFrame:
    """Add the writer slot, the number of the task that reads the event.

    A source cuts what a trigger takes into tasks of bounded size, so the slots
    of a busy hour grow with its volume.
    """
    return events.withColumn(SLOT, F.spark_partition_id())


def spread_for_writing(rows: DataFrame) -> DataFrame:
    """Send the events of an hour and slot to one writer, so that an hour has as many as its volume asks for.

    The number of tasks is stated, because Spark would otherwise merge them by
    size, while the cost of such a write lies in the number of files.
    """
    writers = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(writers, *S.PARTITION_KEYS, SLOT)


def _trigger(once: bool, interval: str) -> dict:
    return {"availableNow": True} if once else {"processingTime": interval}


def write_lake(
    enriched: DataFrame,
    path: str,
    checkpoint: str,
    once: bool = False,
    interval: str = BUFFER_INTERVAL,
) -> StreamingQuery:
    """Start writing enriched events as Snappy Parquet by year, month, day and hour.

    The files of an hour grow with the tasks that read it, and so with its volume.
    """
    if SLOT not in enriched.columns:
        enriched = with_slot(enriched)
    rows = spread_for_writing(lake_columns(enriched, SLOT)).drop(SLOT)
    return (
        rows.writeStream.format("parquet")
        .partitionBy(*S.PARTITION_KEYS)
        .option("compression", "snappy")
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(once, interval))
        .start(path)
    )


def write_errors(
    rejected: DataFrame, path: str, checkpoint: str, once: bool = False, interval: str = BUFFER_INTERVAL
) -> StreamingQuery:
    """Start writing malformed events, with the reason, as JSON lines."""
    return (
        rejected.writeStream.format("json")
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(once, interval))
        .start(path)
    )


def with_reason_counts(rejected: DataFrame) -> DataFrame:
    """Count the rejected events of each trigger by reason, as they pass."""
    counts = [F.count_if(F.col(REASON) == r).alias(r) for r in REASONS]
    others = F.count_if(~F.coalesce(F.col(REASON).isin(*REASONS), F.lit(False))).alias(OTHER)
    return rejected.observe(REJECTED, *counts, others)


def stage_counts(queries: list[StreamingQuery]) -> dict[str, int]:
    """Events written, and events rejected by reason, over the triggers that the queries still know.

    A query keeps the progress of its last 100 triggers
    (``spark.sql.streaming.numRecentProgressUpdates``). Without de-duplication the
    counts add up to the events read.
    """
    out: dict[str, int] = {}
    for query in queries:
        for progress in query.recentProgress:
            for name, row in (progress["observedMetrics"] or {}).items():
                counts = row.asDict() if hasattr(row, "asDict") else dict(row)
                for key, n in counts.items():
                    key = name if name == WRITTEN else key
                    out[key] = out.get(key, 0) + n
    return {k: n for k, n in out.items() if n}


def replay(
    spark: SparkSession,
    path: str,
    target: str,
    table: str,
    start: datetime,
    end: datetime,
    tz: str = "UTC",
    processor: Callable[[DataFrame], DataFrame] | None = None,
) -> int:
    """Read again what arrived at a file source from ``start`` to before ``end``, and merge it into the table at ``target``.

    Files count by the time of their last change, at UTC. Their events are
    enriched into a side lake and taken in by ``compact``, so events that the
    table has are not added again and a window can be replayed any number of
    times. Returns the number of events added.
    """
    form = "%Y-%m-%dT%H:%M:%S"
    # Both bounds are exclusive and in whole seconds.
    window = {"modifiedAfter": (start - timedelta(seconds=1)).strftime(form), "modifiedBefore": end.strftime(form), "timeZone": "UTC"}
    events = spark.read.options(**window).text(path)
    enriched = events.transform(processor or (lambda df: enrich_events(df, tz)))
    side = scratch_path(spark, "replay")
    try:
        write_partitioned(lake_columns(enriched), side)
        return compact(spark, side, target, table)
    finally:
        discard(spark, side)


def run_stream(
    events: DataFrame,
    root: str,
    tz: str = "UTC",
    processor: Callable[[DataFrame], DataFrame] | None = None,
    dedupe: bool = False,
    once: bool = False,
    interval: str = BUFFER_INTERVAL,
    rejects: Callable[[DataFrame], DataFrame] | None = None,
    envelopes: bool = False,
) -> list[StreamingQuery]:
    """Start both queries on a stream of JSON events in column ``value``.

    Data goes to ``<root>/data``, errors to ``<root>/errors``, and the state of
    the queries to ``<root>/checkpoints``. With ``once`` they process what is
    there and stop. ``processor`` replaces ``enrich_events``; it turns the raw
    events into rows of the lake table with their partition keys, and
    ``rejects`` those that it leaves out into rows with a ``reason``. With
    ``envelopes`` the events are records with base64 ``data``; records that
    cannot be decoded go to the errors as well.
    """
    if envelopes:
        events = events.transform(decode_envelopes)
    enriched = events.transform(processor or (lambda df: enrich_events(df, tz)))
    # The slot names the task that reads an event, before events are dealt out by id.
    enriched = with_slot(enriched)
    if dedupe:
        enriched = dedupe_stream(enriched)
    enriched = enriched.observe(WRITTEN, F.count(F.lit(1)).alias("rows"))
    errors = with_reason_counts(events.transform(rejects or rejected_events))
    return [
        write_lake(enriched, f"{root}/data", f"{root}/checkpoints/data", once, interval),
        write_errors(errors, f"{root}/errors", f"{root}/checkpoints/errors", once, interval),
    ]
