"""Event enrichment. Pure column work: the same functions serve batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot import schemas as S
from earshot.functions import events as E
from earshot.functions.calendar import date_parts, instant, iso_seconds, wall_clock
from earshot.functions.text import decode_text, encode_text

REASON = "reason"
UNDECODABLE = "not base64 of UTF-8 text"
NO_TEXT, NO_OBJECT, NO_NAME, NO_TIME = "no text", "not a JSON object", "event_name is not a text", "created_at is not a time"
REASONS = (NO_TEXT, NO_OBJECT, NO_NAME, NO_TIME, UNDECODABLE)


def _computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters refer to without repeating their expressions.

    Spark moves a filter below a projection by copying the projected expressions
    into it, which would parse each event many times. It does not move a filter
    below a generator, so a one-row ``inline`` keeps the parsing to one place.
    """
    values = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline(F.array(values)))


def parse_events(df: DataFrame, text: str = "value") -> DataFrame:
    """Add what enrichment needs of a JSON event: payload, name and time.

    Adds ``payload`` (VARIANT: an array holding the event), ``event_uuid``,
    ``event_name``, ``created_seconds`` and ``reason``, null for a good event.
    """
    given, payload = F.col(text), F.col("payload")
    name_kind, time_kind = F.col("_name_kind"), F.col("_time_kind")
    parsed = _computed_once(df, payload=E.json_array(given))
    parsed = _computed_once(
        parsed,
        _is_object=E.is_one_object(payload, given),
        _name_kind=E.field_kind(payload, "event_name"),
        _time_kind=E.field_kind(payload, "created_at"),
    )
    parsed = _computed_once(
        parsed,
        event_uuid=E.field(payload, "event_uuid", "string"),
        event_name=E.text_value(name_kind, payload, "event_name"),
        created_seconds=E.seconds_value(time_kind, payload, "created_at"),
    )
    in_range = F.col("created_seconds").between(E.MIN_SECOND, E.MAX_SECOND)
    reason = (
        F.when(given.isNull(), NO_TEXT)
        .when(~F.col("_is_object"), NO_OBJECT)
        .when(F.col("event_name").isNull(), NO_NAME)
        .when(F.col("created_seconds").isNull() | ~in_range, NO_TIME)
    )
    return parsed.withColumn(REASON, reason).drop("_is_object", "_name_kind", "_time_kind")


def good(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(REASON).isNull())


def bad(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(REASON).isNotNull())


def event_columns(name: Column, local: Column) -> dict[str, Column]:
    """The three fields that enrichment adds, from the event's name and local time."""
    return {
        "created_datetime": iso_seconds(local),
        "event_type": E.event_type(name),
        "event_subtype": E.event_subtype(name),
    }


def _local(tz: str) -> Column:
    return wall_clock(E.whole_seconds(F.col("created_seconds")), tz)


def enrich_events(df: DataFrame, tz: str = "UTC", text: str = "value") -> DataFrame:
    """JSON events as rows of the lake table with their partition keys.

    Malformed events are left out; ``rejected_events`` returns them. Calendar
    values are in the zone ``tz``.
    """
    local = _local(tz)
    added = event_columns(F.col("event_name"), local)
    return good(parse_events(df, text)).select(
        "event_uuid",
        "event_name",
        instant(F.col("created_seconds")).alias("created_at"),
        *[value.alias(name) for name, value in added.items()],
        *[value.alias(name) for name, value in date_parts(local).items()],
    )


def enrich_payload(df: DataFrame, tz: str = "UTC", text: str = "value") -> DataFrame:
    """Add ``enriched``: the event as JSON with the new fields, all others kept."""
    added = event_columns(F.col("event_name"), _local(tz))
    return good(parse_events(df, text)).withColumn("enriched", E.merged_payload(F.col("payload"), F.col(text), added))


def rejected_events(df: DataFrame, text: str = "value") -> DataFrame:
    """Malformed events as they came, with the reason. Of records, also those whose ``data`` cannot be decoded."""
    parsed = parse_events(df, text)
    if "data" in df.columns:
        undecodable = F.col("data").isNotNull() & F.col(text).isNull()
        parsed = parsed.withColumn(REASON, F.when(undecodable, UNDECODABLE).otherwise(F.col(REASON)))
    return bad(parsed).select(*df.columns, REASON)


def decode_envelopes(envelopes: DataFrame) -> DataFrame:
    """Add ``value``, the JSON text of the base64 field ``data`` (null if not decodable)."""
    return envelopes.withColumn("value", decode_text(F.col("data")))


def process_envelopes(envelopes: DataFrame, tz: str = "UTC") -> DataFrame:
    """Records ``recordId, data`` to records ``recordId, result, data, metadata``.

    ``data`` is re-encoded with the added fields, ``metadata.partitionKeys`` has
    year, month, day and hour. Records that cannot be processed are left out.
    """
    enriched = enrich_payload(decode_envelopes(envelopes), tz)
    keys = F.struct(*[value.alias(name) for name, value in date_parts(_local(tz)).items()])
    return enriched.select(
        "recordId",
        F.lit("Ok").alias("result"),
        encode_text(F.col("enriched")).alias("data"),
        F.struct(keys.alias("partitionKeys")).alias("metadata"),
    )


def rejected_envelopes(envelopes: DataFrame) -> DataFrame:
    """Envelopes that ``process_envelopes`` leaves out, with the reason."""
    return rejected_events(decode_envelopes(envelopes)).select("recordId", "data", REASON)


def lake_columns(df: DataFrame, *more: str) -> DataFrame:
    """The columns of the lake table, in order, partition keys last, and what else is named."""
    return df.select(*S.LAKE_EVENT.names, *S.PARTITION_KEYS, *more)
