"""

The driver's tables stand in for a listening log and an event stream:
``events`` are the listens (``event_type`` serves as song and artist) and also
the raw events, ``customer`` are the users.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from earshot import schemas as S
from earshot.functions.calendar import date_parts, days_between, epoch_seconds
from earshot.functions.events import event_subtype, event_type
from earshot.functions.text import decode_text, encode_text, hash_key, strip
from earshot.operators.bitmaps import day_bitmaps, dense_numbers, distinct_rolling
from earshot.operators.dedupe import keep_first
from earshot.operators.grouping import distinct_total, group_count, percent_of, with_group_count
from earshot.operators.integrity import orphans, quarantine_orphans
from earshot.operators.ordered import lagged, row_numbers
from earshot.operators.sizing import scratch_path, staged
from earshot.operators.union import union_by_name
from earshot.operators.upsert import new_rows
from earshot.operators.validation import Rule, RuleSet, not_blank, not_null, rejected_rows, valid_rows
from earshot.plans import analyses as A
from earshot.plans.etl import rejected_table, run_etl, transform, valid_table
from earshot.plans.publish import publish, published_star
from earshot.plans.sql import analysis, run_sql
from earshot.plans.star import calendar_columns
from earshot.sources.lake import compact, dedupe_events, read_lake, register_lake, write_partitioned
from earshot.sources.listens import ORDINAL, extract, flatten, malformed_lines, raw_lines
from earshot.sources.packing import pack, packed_lake
from earshot.sources.tables import list_tables, star_tables
from earshot.sources.zip_lines import write_archives
from earshot.streaming import enrich as N
from earshot.streaming import jobs as J

logger = logging.getLogger(__name__)

SMOKE_DIR = "/root/testdata/sf0.001"
DAY = date(2024, 1, 5)

# --- the driver's tables in the package's shapes -----------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def listens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("listen_id"),
        "user_id",
        F.col("ts").alias("listen_time"),
        F.col("event_type").alias("song_name"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("user_name")
    )


def times(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("listen_time")
    parts = date_parts(ts)
    return listens(spark, sf_dir).select("listen_time").distinct().withColumns({"date": F.to_date(ts), **parts})


def raw_listens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested shape of the log; one listen in eight lacks its album."""
    events, customer = table(spark, sf_dir, "events"), table(spark, sf_dir, "customer")
    named = events.join(customer, F.col("user_id") == F.col("c_custkey"))
    artist = F.struct(F.col("event_type").alias("artist_msid"))
    track = F.struct(
        F.concat_ws(" ", "event_type", "props").alias("track_name"),
        F.when(F.col("event_id") % 8 != 0, F.col("props")).alias("release_name"),
        F.upper("event_type").alias("artist_name"),
        artist.alias("additional_info"),
    )
    return named.select(
        F.col("c_name").alias("user_name"),
        F.col("event_id").cast("string").alias("recording_msid"),
        epoch_seconds(F.col("ts")).cast("string").alias("listened_at"),
        track.alias("track_metadata"),
        F.col("event_id").alias(ORDINAL),
    )


def event_name():
    """Three shapes: two colons, one colon, none."""
    return (
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("payment:order:"), "event_type"))
        .when(F.col("event_id") % 3 == 1, F.concat(F.lit("account:"), "event_type"))
        .otherwise(F.col("event_type"))
    )


def json_events(events: DataFrame) -> DataFrame:
    """Events as JSON lines in ``value``, with fields the stream does not know."""
    fraction = F.date_part(F.lit("SECOND"), "ts") % 1
    seconds = (epoch_seconds(F.col("ts")) + fraction).cast("decimal(16,6)")
    fields = F.struct(
        F.col("event_id").cast("string").alias("event_uuid"),
        event_name().alias("event_name"),
        seconds.alias("created_at"),
        F.struct(F.col("user_id").alias("user"), F.col("event_type").alias("kind")).alias("context"),
    )
    return events.select("event_id", F.to_json(fields).alias("value"))


def damaged_events(events: DataFrame) -> DataFrame:
    """The same with four kinds of damage spread over the rows."""
    kind = F.col("event_id") % 9
    text = F.col("value")
    broken = (
        F.when(kind == 1, F.concat(text, F.lit("}")))
        .when(kind == 3, F.replace(text, F.lit('"created_at"'), F.lit('"made_at"')))
        .when(kind == 5, F.regexp_replace(text, '"event_name":"[^"]*"', '"event_name":7'))
        .when(kind == 7, F.concat(F.lit("["), text, F.lit("]")))
        .otherwise(text)
    )
    return json_events(events).withColumn("value", broken)


# --- operators ------------------------------------------------------------------------


def dim_users(spark, d):
    return valid_table(raw_listens(spark, d), "users").select("user_id", "user_name")


def dim_artists(spark, d):
    return valid_table(raw_listens(spark, d), "artists").select("artist_id", "artist_name")


def dim_time(spark, d):
    return valid_table(raw_listens(spark, d), "time").select(*S.TIME.names)


def fact_listens(spark, d):
    return valid_table(raw_listens(spark, d), "user_listens").select(*S.USER_LISTENS.names)


def fact_rejects(spark, d):
    bad = rejected_table(raw_listens(spark, d), "user_listens")
    return bad.select("listen_id", F.array_join("reasons", "; ").alias("reasons"))


def distinct_rows(spark, d):
    return table(spark, d, "events").select("user_id", "event_type").distinct()


def dedupe_keep_first(spark, d):
    return keep_first(table(spark, d, "documents"), "text", ["doc_id"]).select("doc_id", "source", "n_chars")


ORDER_RULES = RuleSet(
    "orders",
    "o_custkey",
    S.T.StructType([S.T.StructField("o_custkey", S.T.LongType())]),
    (
        not_null("o_custkey"),
        not_blank("o_orderpriority"),
        Rule("o_orderstatus", "pending", lambda c: c != "P"),
        Rule("o_totalprice", "below 1000", lambda c: c >= 1000),
    ),
)


def validate_rows(spark, d):
    valid = valid_rows(table(spark, d, "orders"), ORDER_RULES, "o_orderkey")
    return valid.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")


def dead_letter(spark, d):
    bad = rejected_rows(table(spark, d, "orders"), ORDER_RULES, "o_orderkey")
    return bad.select("o_orderkey", F.array_join("reasons", "; ").alias("reasons"))


def non_blank_strip(spark, d):
    padded = F.concat(F.lit(" \t"), F.when(F.col("event_id") % 2 == 0, F.col("event_type")).otherwise(""), F.lit("\t "))
    events = table(spark, d, "events").select("event_id", strip(padded).alias("stripped"))
    return events.where(F.col("stripped") != "")


def insert_or_ignore(spark, d):
    batch = table(spark, d, "events").select("event_id", "user_id", "value")
    stored = table(spark, d, "events").where("event_type = 'view'").select("event_id", "user_id", F.lit(0.0).alias("value"))
    return stored.unionByName(new_rows(batch, stored, ["event_id"], "event_id"))


def fk_orphans(spark, d):
    parents = table(spark, d, "customer").where("c_mktsegment <> 'BUILDING'")
    return orphans(table(spark, d, "events"), "user_id", parents, "c_custkey").select("event_id", "user_id")


def fk_quarantine(spark, d):
    parents = table(spark, d, "customer").where("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("user_id"))
    _, bad = quarantine_orphans(table(spark, d, "events").select("event_id", "user_id"), {"user_id": parents})
    return bad.select("event_id", F.array_join("reasons", "; ").alias("reasons"))


def union_by_name_(spark, d):
    events = table(spark, d, "events")
    left = events.where("event_type = 'view'").select("event_id", "user_id")
    right = events.where("event_type <> 'view'").select("value", "event_id")
    return union_by_name([left, right])


def join_users(spark, d):
    return listens(spark, d).join(users(spark, d), "user_id").select("listen_id", "user_name", "song_name")


def join_time(spark, d):
    return listens(spark, d).join(times(spark, d), "listen_time").select("listen_id", "date", "hour")


def group_count_(spark, d):
    return group_count(listens(spark, d), "user_id", "listen_id", "listen_count")


def sort_multi(spark, d):
    return A.user_days(listens(spark, d)).orderBy(F.asc("user_id"), F.desc("listen_count"), F.asc("date"))


def scalar_subquery_pct(spark, d):
    counts = group_count(listens(spark, d), "song_name", "listen_id", "n")
    return counts.withColumn("pct", percent_of(F.col("n"), distinct_total(users(spark, d), "user_id")))


def null_safe_filter(spark, d):
    kind = F.nullif(F.col("event_type"), F.lit("error"))
    return table(spark, d, "events").where(~kind.eqNullSafe(F.lit(None))).select("event_id", "event_type")


def in_list(spark, d):
    return table(spark, d, "events").where(F.col("event_type").isin("click", "view", "signup")).select("event_id", "event_type")


def date_diff(spark, d):
    days = days_between(F.lit(date(2024, 1, 1)), F.to_date("ts")).cast("bigint")
    return table(spark, d, "events").select("event_id", days.alias("days"))


def win_row_number(spark, d, **kw):
    numbered = row_numbers(listens(spark, d), "user_id", "listen_time", ["listen_id"], "rn", newest_first=True, **kw)
    return numbered.select("listen_id", "user_id", "rn")


def win_row_number_sliced(spark, d):
    """The same with every user of more than 60 listens cut into time slices."""
    return win_row_number(spark, d, max_rows=60)


def win_dense_rank(spark, d):
    by_count = W.partitionBy("user_id").orderBy(F.desc("listen_count"))
    ranked = A.user_days(listens(spark, d)).withColumn("listen_rank", F.dense_rank().over(by_count))
    return ranked.select("user_id", "date", F.col("listen_rank").cast("bigint").alias("listen_rank"))


def win_lag(spark, d, **kw):
    dated = A.dated(listens(spark, d))
    out = lagged(dated, "user_id", "listen_time", ["listen_id"], "date", 6, "six_before", **kw)
    return out.select("listen_id", "date", "six_before")


def win_lag_sliced(spark, d):
    """The same with every user of more than 60 listens cut into time slices."""
    return win_lag(spark, d, max_rows=60)


def win_count_ordered(spark, d):
    return A.user_days(listens(spark, d))


def win_count_partition(spark, d):
    days = A.dated(listens(spark, d)).select("user_id", "date").distinct()
    return with_group_count(days, "date", "user_id", "n_users", stage=True)


# --- events -----------------------------------------------------------------------------


def event_type_parts(spark, d):
    name = event_name()
    return table(spark, d, "events").select(
        "event_id", event_type(name).alias("event_type"), event_subtype(name).alias("event_subtype")
    )


def partition_keys(spark, d):
    columns = calendar_columns(epoch_seconds(F.col("ts")))
    return table(spark, d, "events").select("event_id", *[columns[k].alias(k) for k in S.PARTITION_KEYS[:3]], date_parts(F.col("ts"))["hour"].alias("hour"))


def partition_layout(spark, d):
    path = scratch_path(spark, "layout")
    write_partitioned(N.enrich_events(json_events(table(spark, d, "events"))), path)
    return read_lake(spark, path).groupBy(*S.PARTITION_KEYS).agg(F.count("event_uuid").alias("n"))


def _lake_view(df: DataFrame) -> DataFrame:
    """Lake rows with the instant as a number, free of the session's time zone."""
    created = F.unix_micros("created_at").alias("created_us")
    return df.select("event_uuid", "event_name", created, "created_datetime", "event_type", "event_subtype", *S.PARTITION_KEYS)


def enrich_events(spark, d):
    return _lake_view(N.enrich_events(json_events(table(spark, d, "events"))))


def enrich_events_zone(spark, d):
    return _lake_view(N.enrich_events(json_events(table(spark, d, "events")), tz="Asia/Kolkata"))


def event_errors(spark, d):
    return N.rejected_events(damaged_events(table(spark, d, "events"))).select("event_id", "reason")


def json_flatten(spark, d):
    nested = table(spark, d, "events").select(
        "event_id", F.from_json("props", "k int").alias("props"), F.struct(F.struct("user_id").alias("who")).alias("meta")
    )
    flat = flatten(nested)
    return flat.select("event_id", F.col("`props.k`").alias("k"), F.col("`meta.who.user_id`").alias("who"))


def json_enrich(spark, d):
    merged = F.parse_json("enriched")
    rows = N.enrich_payload(json_events(table(spark, d, "events")))

    def read(path, kind):
        return F.variant_get(merged, path, kind)

    return rows.select(
        read("$.event_uuid", "string").alias("event_uuid"),
        read("$.created_at", "decimal(16,6)").cast("string").alias("created_at"),
        read("$.created_datetime", "string").alias("created_datetime"),
        read("$.event_type", "string").alias("event_type"),
        read("$.event_subtype", "string").alias("event_subtype"),
        read("$.context.user", "bigint").alias("context_user"),
        read("$.context.kind", "string").alias("context_kind"),
    )


def base64_roundtrip(spark, d):
    encoded = table(spark, d, "documents").select("doc_id", encode_text(F.col("text")).alias("encoded"))
    return encoded.select("doc_id", "encoded", hash_key(decode_text(F.col("encoded"))).alias("decoded_sha"))


def envelope(spark, d):
    events = json_events(table(spark, d, "events"))
    records = events.select(F.concat(F.lit("rec-"), "event_id").alias("recordId"), encode_text(F.col("value")).alias("data"))
    out = N.process_envelopes(records)
    payload = F.parse_json(decode_text(F.col("data")))
    return out.select(
        F.col("recordId").alias("record_id"),
        "result",
        F.variant_get(payload, "$.created_datetime", "string").alias("created_datetime"),
        F.variant_get(payload, "$.event_type", "string").alias("event_type"),
        F.variant_get(payload, "$.context.user", "bigint").alias("context_user"),
        *[F.col(f"metadata.partitionKeys.{k}").alias(k) for k in S.PARTITION_KEYS],
    )


def nameless_events(events: DataFrame) -> DataFrame:
    """JSON events of which every tenth lacks its id."""
    text = F.col("value")
    without = F.regexp_replace(text, '"event_uuid":"[^"]*",', "")
    return json_events(events).withColumn("value", F.when(F.col("event_id") % 10 == 0, without).otherwise(text))


def batch_dedupe(spark, d):
    """Copies that are later and have another name, and events without an id, of which both copies stay."""
    events = table(spark, d, "events")
    later = events.withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 DAY")).withColumn("event_type", F.upper("event_type"))
    both = nameless_events(later).unionByName(nameless_events(events))
    return dedupe_events(N.enrich_events(both)).select("event_uuid", "event_name")


def lake_table(spark, d):
    """The lake as an external table of the catalog."""
    path, name = scratch_path(spark, "lake"), f"lake_{uuid.uuid4().hex}"
    write_partitioned(N.enrich_events(json_events(table(spark, d, "events"))), path)
    register_lake(spark, name, path)
    return spark.table(name).where("month = 1").select("event_uuid", "day", "hour")


def lake_compact(spark, d):
    """Two runs of compaction over parts of the stream that overlap, every tenth event without an id."""
    root, name = scratch_path(spark, "compacted"), f"compacted_{uuid.uuid4().hex}"
    events = table(spark, d, "events")
    for low in (0, 1):
        part = events.where((F.col("event_id") % 3).between(low, low + 1))
        write_partitioned(N.enrich_events(nameless_events(part.unionByName(part))), f"{root}/lake", "overwrite")
        compact(spark, f"{root}/lake", f"{root}/table", name)
    return spark.table(name).select("event_uuid", "event_name", "hour")


def _event_stream(spark, d):
    """The event table as a file stream of JSON lines."""
    schema = table(spark, d, "events").schema
    source = J.read_events(spark, "parquet", f"{d}/events*.parquet", schema)
    return json_events(source)


def _drain(stream: DataFrame, spark: SparkSession, **options) -> DataFrame:
    root = scratch_path(spark, "stream")
    queries = J.run_stream(stream, root, once=True, **options)
    for query in queries:
        query.awaitTermination()
    return read_lake(spark, f"{root}/data")


def stream_enrich(spark, d):
    return _lake_view(_drain(_event_stream(spark, d), spark))


def stream_dedupe(spark, d):
    """Each event in two of several files that are not in order of time, one file for each trigger, every tenth without an id."""
    path = scratch_path(spark, "events")
    events = table(spark, d, "events")
    mixed = nameless_events(events.unionByName(events)).repartition(5, F.rand(7)).select("value")
    mixed.write.text(path)
    stream = J.read_events(spark, "text", path, maxFilesPerTrigger="1")
    return _drain(stream, spark, dedupe=True).select("event_uuid", "event_type")


def stream_envelope(spark, d):
    """Records with base64 data."""
    records = _event_stream(spark, d).select(F.concat(F.lit("rec-"), "event_id").alias("recordId"), encode_text(F.col("value")).alias("data"))
    return _lake_view(_drain(records, spark, envelopes=True))


def stream_processor(spark, d):
    """A processor of one's own: payments only, others are its rejects."""
    payments = F.col("event_type") == "payment"
    kept = _drain(
        _event_stream(spark, d),
        spark,
        processor=lambda df: N.enrich_events(df).where(payments),
        rejects=lambda df: N.enrich_events(df).where(~payments).select("event_uuid", F.lit("no payment").alias("reason")),
    )
    return kept.select("event_uuid", "event_name")


# --- the log as files, the star as tables -------------------------------------------------


def _log(spark, d):
    path = f"{scratch_path(spark, 'log')}/listens.json"
    raw_listens(spark, d).drop(ORDINAL).write.json(path)
    return path


def scan_json_lines(spark, d):
    """The log written as JSON lines, read and flattened."""
    flat = flatten(extract(spark, _log(spark, d)))
    names = {"recording_msid": "id", "user_name": "user_name", "listened_at": "listened_at", "track_metadata.release_name": "album"}
    return flat.select(*[F.col(f"`{path}`").alias(name) for path, name in names.items()])


def _zip_log(spark, d, lines) -> str:
    folder = scratch_path(spark, "log")
    write_archives(lines, folder)
    return f"{folder}/*.zip"


def scan_zip_lines(spark, d):
    """The log written as archives, one for each task, read and flattened."""
    lines = raw_listens(spark, d).drop(ORDINAL).select(F.to_json(F.struct("*")).alias("value"))
    flat = flatten(extract(spark, _zip_log(spark, d, lines)))
    return flat.select("recording_msid", "user_name", F.col("`track_metadata.release_name`").alias("album"))


def malformed_places(spark, d):
    """Cut lines of archives, with their places checked against the lines found there."""
    line = F.concat(F.lit('{"recording_msid":"'), F.col("event_id"), F.when(F.col("event_id") % 9 == 0, "").otherwise('"}'))
    path = _zip_log(spark, d, table(spark, d, "events").select(line.alias("value")))
    there = raw_lines(spark, path).select(
        F.col("archive").alias("file"), F.col("name").alias("member"), (F.col("line") + 1).alias("line"), F.col("value").alias("there")
    )
    return malformed_lines(spark, path).join(there, ["file", "member", "line"]).select(F.col("value").alias("found"), "there")


def _loaded(spark, d) -> str:
    """A database into which the log was loaded twice."""
    database = f"star_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, 'star')}'")
    path = _log(spark, d)
    for _ in range(2):
        run_etl(spark, path, database).discard()
    return database


def etl_published(spark, d):
    """Rows of each table of the second version: the log in two parts that overlap, published one after the other."""
    root, raw = scratch_path(spark, "published"), raw_listens(spark, d)
    for name, part in (("first", raw.where(F.col(ORDINAL) % 3 < 2)), ("second", raw.where(F.col(ORDINAL) % 3 > 0))):
        part.drop(ORDINAL).write.json(f"{root}-log/{name}.json")
        run_etl(spark, f"{root}-log/{name}.json", root, store=publish).discard()
    tables = published_star(spark, root)
    return union_by_name([df.agg(F.lit(name).alias("name"), F.count("*").alias("n")) for name, df in tables.items()])


def lake_packed(spark, d):
    """The files of a stream of several triggers, packed; the newest hours are open and stay as they are."""
    path, root = scratch_path(spark, "events"), scratch_path(spark, "stream")
    json_events(table(spark, d, "events")).repartition(3).select("value").write.text(path)
    for query in J.run_stream(J.read_events(spark, "text", path, maxFilesPerTrigger="1"), root, once=True):
        query.awaitTermination()
    pack(spark, f"{root}/data", f"{root}/packed", closed_before=datetime(2024, 1, 20))
    return packed_lake(spark, f"{root}/packed", f"{root}/data").select("event_uuid", "day", "hour")


def etl_tables(spark, d):
    """Rows of each table that the database lists."""
    database = _loaded(spark, d)
    counts = [spark.table(f"{database}.{t}").agg(F.lit(t).alias("name"), F.count("*").alias("n")) for t in list_tables(spark, database)]
    return union_by_name(counts)


def etl_fact(spark, d):
    return spark.table(f"{_loaded(spark, d)}.user_listens")


def etl_users_on_day(spark, d):
    return analysis(spark, "users_on_day", _loaded(spark, d), year=DAY.year, month=DAY.month, day=DAY.day)


def etl_top_days(spark, d):
    return A.top_days(star_tables(spark, _loaded(spark, d))["user_listens"])


TYPED = RuleSet("typed", "event_id", S.T.StructType([S.T.StructField("event_id", S.T.LongType()), S.T.StructField("amount", S.T.IntegerType())]), ())


def type_conformance(spark, d):
    """Values that do not fit their column: a word, a fraction, a number too large."""
    kind = F.col("event_id") % 7
    odd = F.when(kind == 1, "many").when(kind == 3, "99999999999").when(kind == 5, None)
    texts = table(spark, d, "events").select("event_id", F.when(kind.isin(1, 3, 5), odd).otherwise(F.col("event_id").cast("string")).alias("amount"))
    return valid_rows(texts, TYPED, "event_id").select("event_id", "amount")


def blank_texts(spark, d):
    """Blank and empty priorities are rejected; a null is the business of another rule."""
    kind = F.col("o_orderkey") % 5
    blank = F.when(kind == 0, " \t").when(kind == 1, "").when(kind == 2, None).otherwise(F.col("o_orderpriority"))
    rules = RuleSet("texts", "o_orderkey", S.T.StructType([S.T.StructField("o_orderkey", S.T.LongType())]), (not_blank("o_orderpriority"),))
    bad = rejected_rows(table(spark, d, "orders").withColumn("o_orderpriority", blank), rules, "o_orderkey")
    return bad.select("o_orderkey", F.array_join("reasons", "; ").alias("reasons"))


def stream_errors(spark, d):
    schema = table(spark, d, "events").schema
    stream = damaged_events(J.read_events(spark, "parquet", f"{d}/events*.parquet", schema))
    root = scratch_path(spark, "stream")
    for query in J.run_stream(stream, root, once=True):
        query.awaitTermination()
    return spark.read.schema("event_id bigint, reason string").json(f"{root}/errors")


# --- analyses ------------------------------------------------------------------------------


def q_top_users(spark, d):
    return A.top_users(listens(spark, d), users(spark, d))


def q_users_on_day(spark, d):
    return A.users_on_day(listens(spark, d), DAY)


def q_users_on_day_joined(spark, d):
    return A.users_on_day(listens(spark, d), DAY, times(spark, d))


def q_user_song(spark, d):
    return A.latest_song(listens(spark, d), users(spark, d))


def q_user_first_song(spark, d):
    return A.first_song(listens(spark, d), users(spark, d))


def q_top_days(spark, d):
    return A.top_days(listens(spark, d))


def q_top_days_joined(spark, d):
    return A.top_days(listens(spark, d), times(spark, d))


def q_daily_active(spark, d):
    return A.daily_active(listens(spark, d), users(spark, d))


def q_daily_active_7day(spark, d):
    return A.daily_active_7day(listens(spark, d), users(spark, d))


def _distinct_users(days: int):
    """Users of the last days, for each day, from bitmaps; the listens are read for these alone."""

    def query(spark, d):
        rows = listens(spark, d).select("user_id", F.to_date("listen_time").alias("date"))
        bitmaps = day_bitmaps(rows, dense_numbers(rows, "user_id"), "user_id", "date")
        return distinct_rolling(staged(bitmaps, scratch_path(spark, "bitmaps")), days)

    return query


def _sql(name: str, **args):
    def query(spark, d):
        tables = {"user_listens": listens(spark, d), "users": users(spark, d), "time": times(spark, d)}
        return run_sql(spark, name, tables, **args)

    return query


# --- contract ------------------------------------------------------------------------------


def _llm():
    """The query modules of the training-data operators, if they can be imported."""
    try:
        from earshot.llm import queries as llm_queries
    except ImportError as error:
        logger.warning("The training-data operators are left out: %s", error)
        return None
    return llm_queries


def entry(spark: SparkSession) -> DataFrame:
    """Top users over the star schema built from the raw listens."""
    star = transform(raw_listens(spark, SMOKE_DIR))
    return A.top_users(star["user_listens"], star["users"])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    llm = _llm()
    return {
        **(llm.queries() if llm else {}),
        "dim_users": dim_users,
        "dim_artists": dim_artists,
        "dim_time": dim_time,
        "fact_listens": fact_listens,
        "fact_rejects": fact_rejects,
        "distinct_rows": distinct_rows,
        "dedupe_keep_first": dedupe_keep_first,
        "validate_rows": validate_rows,
        "dead_letter": dead_letter,
        "non_blank_strip": non_blank_strip,
        "insert_or_ignore": insert_or_ignore,
        "fk_orphans": fk_orphans,
        "fk_quarantine": fk_quarantine,
        "union_by_name": union_by_name_,
        "join_users": join_users,
        "join_time": join_time,
        "group_count": group_count_,
        "sort_multi": sort_multi,
        "scalar_subquery_pct": scalar_subquery_pct,
        "null_safe_filter": null_safe_filter,
        "in_list": in_list,
        "date_diff": date_diff,
        "win_row_number": win_row_number,
        "win_row_number_sliced": win_row_number_sliced,
        "win_dense_rank": win_dense_rank,
        "win_lag": win_lag,
        "win_lag_sliced": win_lag_sliced,
        "win_count_ordered": win_count_ordered,
        "win_count_partition": win_count_partition,
        "event_type_parts": event_type_parts,
        "partition_keys": partition_keys,
        "partition_layout": partition_layout,
        "enrich_events": enrich_events,
        "enrich_events_zone": enrich_events_zone,
        "event_errors": event_errors,
        "json_flatten": json_flatten,
        "json_enrich": json_enrich,
        "base64_roundtrip": base64_roundtrip,
        "envelope": envelope,
        "batch_dedupe": batch_dedupe,
        "stream_enrich": stream_enrich,
        "stream_dedupe": stream_dedupe,
        "stream_errors": stream_errors,
        "stream_envelope": stream_envelope,
        "stream_processor": stream_processor,
        "lake_table": lake_table,
        "lake_compact": lake_compact,
        "scan_json_lines": scan_json_lines,
        "scan_zip_lines": scan_zip_lines,
        "malformed_places": malformed_places,
        "etl_tables": etl_tables,
        "etl_published": etl_published,
        "lake_packed": lake_packed,
        "etl_fact": etl_fact,
        "etl_users_on_day": etl_users_on_day,
        "etl_top_days": etl_top_days,
        "type_conformance": type_conformance,
        "blank_texts": blank_texts,
        "q_top_users": q_top_users,
        "q_users_on_day": q_users_on_day,
        "q_users_on_day_joined": q_users_on_day_joined,
        "q_user_song": q_user_song,
        "q_user_first_song": q_user_first_song,
        "q_top_days": q_top_days,
        "q_top_days_joined": q_top_days_joined,
        "q_daily_active": q_daily_active,
        "q_daily_active_7day": q_daily_active_7day,
        "distinct_users_7day": _distinct_users(7),
        "distinct_users_30day": _distinct_users(30),
        "sql_top_users": _sql("top_users"),
        "sql_users_on_day": _sql("users_on_day", year=DAY.year, month=DAY.month, day=DAY.day),
        "sql_latest_song": _sql("latest_song"),
        "sql_first_song": _sql("first_song"),
        "sql_top_days": _sql("top_days"),
        "sql_daily_active": _sql("daily_active"),
        "sql_daily_active_7day": _sql("daily_active_7day"),
    }


# SQL fragments: the shapes above, in the other dialect.
_NAME = (
    "CASE event_id % 3 WHEN 0 THEN 'payment:order:' || event_type "
    "WHEN 1 THEN 'account:' || event_type ELSE event_type END"
)
_TYPE = "CASE event_id % 3 WHEN 0 THEN 'payment' WHEN 1 THEN 'account' ELSE '' END"
_SUBTYPE = "CASE event_id % 3 WHEN 0 THEN 'order' ELSE '' END"
_SECONDS = "epoch_us(ts) // 1000000"


def _keys(ts: str) -> str:
    return ", ".join(f"CAST({k}({ts}) AS INTEGER) AS {k}" for k in ("year", "month", "day", "hour"))


def _lake_sql(ts: str = "ts") -> str:
    return (
        f"SELECT CAST(event_id AS VARCHAR) AS event_uuid, {_NAME} AS event_name, epoch_us(ts) AS created_us, "
        f"strftime({ts}, '%Y-%m-%dT%H:%M:%S') AS created_datetime, {_TYPE} AS event_type, "
        f"{_SUBTYPE} AS event_subtype, {_keys(ts)} FROM events"
    )


_ORDER_FLAGS = (
    "SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) > 1 AS repeated, "
    "regexp_matches(o_orderpriority, '^\\s*$') AS is_blank, o_orderstatus = 'P' AS is_pending, "
    "o_totalprice < 1000 AS is_cheap FROM orders"
)
_FACT = (
    f"SELECT CAST(event_id AS VARCHAR) AS listen_id, sha256(c_name) AS user_id, {_SECONDS} AS listen_time, "
    "event_type AS artist_id, event_type || ' ' || props AS song_name, props AS album_name "
    "FROM events JOIN customer ON c_custkey = user_id WHERE event_id % 8 <> 0"
)
_PER_DAY = "SELECT user_id, CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY ALL"
_ERRORS = (
    "SELECT event_id, CASE event_id % 9 WHEN 1 THEN 'not a JSON object' WHEN 3 THEN 'created_at is not a time' "
    "WHEN 5 THEN 'event_name is not a text' ELSE 'not a JSON object' END AS reason "
    "FROM events WHERE event_id % 9 IN (1, 3, 5, 7)"
)
_USER_COUNT = "(SELECT count(DISTINCT c_custkey) FROM customer)"
_BY_PLACE = "PARTITION BY user_id ORDER BY ts, event_id"


def oracle_sql() -> dict[str, str]:
    newest_number = (
        "SELECT event_id AS listen_id, user_id, "
        "row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn FROM events"
    )
    six_before = (
        "SELECT event_id AS listen_id, CAST(ts AS DATE) AS date, "
        f"lag(CAST(ts AS DATE), 6) OVER ({_BY_PLACE}) AS six_before FROM events"
    )
    on_day = (
        "SELECT count(DISTINCT user_id) AS user_count FROM events "
        "WHERE year(ts) = 2024 AND month(ts) = 1 AND day(ts) = 5"
    )
    best_days = (
        f"SELECT user_id AS user, n AS number_of_listens, d AS date FROM ({_PER_DAY}) "
        "QUALIFY dense_rank() OVER (PARTITION BY user_id ORDER BY n DESC) < 4"
    )

    top_users = (
        "SELECT c_name AS user_name FROM customer WHERE c_custkey IN (SELECT user_id FROM events "
        "GROUP BY user_id ORDER BY count(event_id) DESC, user_id LIMIT 10)"
    )
    active_by_listen = (
        "SELECT active_date, count(*) OVER (PARTITION BY active_date) AS number_of_active_users, "
        f"count(*) OVER (PARTITION BY active_date) / {_USER_COUNT} * 100 AS percentage_active_users "
        "FROM (SELECT DISTINCT user_id, today AS active_date FROM (SELECT user_id, CAST(ts AS DATE) AS today, "
        "lag(CAST(ts AS DATE), 6) OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE)) AS earlier FROM events) "
        "WHERE today - earlier = 6)"
    )
    active_by_day = (
        "SELECT today AS active_date, count(*) AS number_of_active_users, "
        f"count(*) / {_USER_COUNT} * 100 AS percentage_active_users "
        "FROM (SELECT user_id, d AS today, lag(d, 6) OVER (PARTITION BY user_id ORDER BY d) AS earlier "
        f"FROM ({_PER_DAY})) WHERE today - earlier = 6 GROUP BY today"
    )

    rolling = (
        f"SELECT a.d AS date, count(DISTINCT b.user_id) AS n FROM (SELECT DISTINCT d FROM ({_PER_DAY})) AS a "
        f"JOIN ({_PER_DAY}) AS b ON b.d BETWEEN a.d - {{}} AND a.d GROUP BY a.d"
    )

    def edge_song(pick: str) -> str:
        return (
            f"SELECT {pick} AS song_name, max(c_name) AS user_name "
            "FROM events JOIN customer ON c_custkey = user_id GROUP BY user_id"
        )

    llm = _llm()
    return {
        **(llm.oracle_sql() if llm else {}),
        "dim_users": (
            "SELECT sha256(c_name) AS user_id, c_name AS user_name FROM customer "
            "WHERE c_custkey IN (SELECT user_id FROM events)"
        ),
        "dim_artists": "SELECT DISTINCT event_type AS artist_id, upper(event_type) AS artist_name FROM events",
        "dim_time": (
            "SELECT listen_time, make_timestamp(listen_time * 1000000) AS timestamp, "
            "CAST(make_timestamp(listen_time * 1000000) AS DATE) AS date, "
            f"{_keys('make_timestamp(listen_time * 1000000)')}, "
            "dayname(make_timestamp(listen_time * 1000000)) AS day_name "
            f"FROM (SELECT DISTINCT {_SECONDS} AS listen_time FROM events)"
        ),
        "fact_listens": _FACT,
        "fact_rejects": (
            "SELECT CAST(event_id AS VARCHAR) AS listen_id, 'album_name: null' AS reasons "
            "FROM events WHERE event_id % 8 = 0"
        ),
        "distinct_rows": "SELECT user_id, event_type FROM events GROUP BY user_id, event_type",
        "dedupe_keep_first": (
            "SELECT doc_id, source, n_chars FROM documents "
            "QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1"
        ),
        "validate_rows": (
            f"SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM ({_ORDER_FLAGS}) "
            "WHERE NOT (repeated OR is_blank OR is_pending OR is_cheap)"
        ),
        "dead_letter": (
            "SELECT o_orderkey, concat_ws('; ', CASE WHEN is_blank THEN 'o_orderpriority: blank' END, "
            "CASE WHEN is_pending THEN 'o_orderstatus: pending' END, "
            "CASE WHEN is_cheap THEN 'o_totalprice: below 1000' END, "
            f"CASE WHEN repeated THEN 'o_custkey: duplicate' END) AS reasons FROM ({_ORDER_FLAGS}) "
            "WHERE repeated OR is_blank OR is_pending OR is_cheap"
        ),
        "non_blank_strip": "SELECT event_id, event_type AS stripped FROM events WHERE event_id % 2 = 0",
        "insert_or_ignore": (
            "SELECT event_id, user_id, CASE event_type WHEN 'view' THEN 0.0::DOUBLE ELSE value END AS value FROM events"
        ),
        "fk_orphans": (
            "SELECT event_id, user_id FROM events WHERE NOT EXISTS (SELECT 1 FROM customer "
            "WHERE c_custkey = user_id AND c_mktsegment <> 'BUILDING')"
        ),
        "fk_quarantine": (
            "SELECT event_id, 'user_id: no parent' AS reasons FROM events WHERE NOT EXISTS "
            "(SELECT 1 FROM customer WHERE c_custkey = user_id AND c_mktsegment <> 'BUILDING')"
        ),
        "union_by_name": (
            "SELECT event_id, user_id FROM events WHERE event_type = 'view' "
            "UNION ALL BY NAME SELECT value, event_id FROM events WHERE event_type <> 'view'"
        ),
        "join_users": (
            "SELECT event_id AS listen_id, c_name AS user_name, event_type AS song_name "
            "FROM events JOIN customer ON c_custkey = user_id"
        ),
        "join_time": (
            "SELECT event_id AS listen_id, date, hour FROM events JOIN (SELECT DISTINCT ts AS listen_time, "
            "CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour FROM events) ON listen_time = ts"
        ),
        "group_count": "SELECT user_id, count(event_id) AS listen_count FROM events GROUP BY user_id",
        "sort_multi": (
            f"SELECT user_id, d AS date, n AS listen_count FROM ({_PER_DAY}) ORDER BY user_id, n DESC, d"
        ),
        "scalar_subquery_pct": (
            f"SELECT event_type AS song_name, count(*) AS n, count(*) / {_USER_COUNT} * 100 AS pct "
            "FROM events GROUP BY event_type"
        ),
        "null_safe_filter": (
            "SELECT event_id, event_type FROM events WHERE nullif(event_type, 'error') IS DISTINCT FROM NULL"
        ),
        "in_list": "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'view', 'signup')",
        "date_diff": "SELECT event_id, datediff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS days FROM events",
        "win_row_number": newest_number,
        "win_row_number_sliced": newest_number,
        "win_dense_rank": (
            "SELECT user_id, d AS date, dense_rank() OVER (PARTITION BY user_id ORDER BY n DESC) AS listen_rank "
            f"FROM ({_PER_DAY})"
        ),
        "win_lag": six_before,
        "win_lag_sliced": six_before,
        "win_count_ordered": (
            "SELECT DISTINCT user_id, CAST(ts AS DATE) AS date, count(event_id) OVER (PARTITION BY user_id, "
            "CAST(ts AS DATE) ORDER BY CAST(ts AS DATE) DESC) AS listen_count FROM events"
        ),
        "win_count_partition": (
            "SELECT user_id, date, count(user_id) OVER (PARTITION BY date) AS n_users "
            "FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS date FROM events)"
        ),
        "event_type_parts": f"SELECT event_id, {_TYPE} AS event_type, {_SUBTYPE} AS event_subtype FROM events",
        "partition_keys": f"SELECT event_id, {_keys('ts')} FROM events",
        "partition_layout": f"SELECT {_keys('ts')}, count(*) AS n FROM events GROUP BY 1, 2, 3, 4",
        "enrich_events": _lake_sql(),
        "enrich_events_zone": _lake_sql("(ts + INTERVAL 330 MINUTE)"),
        "event_errors": _ERRORS,
        "json_flatten": (
            "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, user_id AS who FROM events"
        ),
        "json_enrich": (
            "SELECT CAST(event_id AS VARCHAR) AS event_uuid, "
            "CAST(CAST(epoch_us(ts) AS DECIMAL(22, 6)) / 1000000 AS DECIMAL(16, 6))::VARCHAR AS created_at, "
            "strftime(ts, '%Y-%m-%dT%H:%M:%S') AS created_datetime, "
            f"{_TYPE} AS event_type, {_SUBTYPE} AS event_subtype, user_id AS context_user, "
            "event_type AS context_kind FROM events"
        ),
        "base64_roundtrip": (
            "SELECT doc_id, base64(encode(text)) AS encoded, sha256(text) AS decoded_sha FROM documents"
        ),
        "envelope": (
            "SELECT 'rec-' || event_id AS record_id, 'Ok' AS result, "
            "strftime(ts, '%Y-%m-%dT%H:%M:%S') AS created_datetime, "
            f"{_TYPE} AS event_type, user_id AS context_user, {_keys('ts')} FROM events"
        ),
        "batch_dedupe": (
            f"SELECT CASE WHEN event_id % 10 <> 0 THEN CAST(event_id AS VARCHAR) END AS event_uuid, {_NAME} AS event_name FROM events "
            f"UNION ALL SELECT NULL, {_NAME.replace('event_type', 'upper(event_type)')} FROM events WHERE event_id % 10 = 0"
        ),
        "lake_table": (
            "SELECT CAST(event_id AS VARCHAR) AS event_uuid, CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour "
            "FROM events WHERE month(ts) = 1"
        ),
        "lake_compact": (
            f"SELECT event_uuid, event_name, hour FROM ({_lake_sql()}) WHERE CAST(event_uuid AS BIGINT) % 10 <> 0 "
            f"UNION ALL SELECT NULL, event_name, hour FROM (SELECT DISTINCT event_name, created_us, hour FROM ({_lake_sql()}) "
            "WHERE CAST(event_uuid AS BIGINT) % 10 = 0)"
        ),
        "distinct_users_7day": rolling.format(6),
        "distinct_users_30day": rolling.format(29),
        "lake_packed": (
            "SELECT CAST(event_id AS VARCHAR) AS event_uuid, CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour FROM events"
        ),
        "stream_envelope": _lake_sql(),
        "stream_processor": (
            f"SELECT CAST(event_id AS VARCHAR) AS event_uuid, {_NAME} AS event_name FROM events WHERE event_id % 3 = 0"
        ),
        "scan_zip_lines": (
            "SELECT CAST(event_id AS VARCHAR) AS recording_msid, c_name AS user_name, "
            "CASE WHEN event_id % 8 <> 0 THEN props END AS album FROM events JOIN customer ON c_custkey = user_id"
        ),
        "malformed_places": (
            "SELECT '{\"recording_msid\":\"' || event_id AS found, '{\"recording_msid\":\"' || event_id AS there "
            "FROM events WHERE event_id % 9 = 0"
        ),
        "scan_json_lines": (
            f"SELECT CAST(event_id AS VARCHAR) AS id, c_name AS user_name, CAST({_SECONDS} AS VARCHAR) AS listened_at, "
            "CASE WHEN event_id % 8 <> 0 THEN props END AS album FROM events JOIN customer ON c_custkey = user_id"
        ),
        "etl_tables": (
            "SELECT 'users' AS name, count(DISTINCT c_name) AS n FROM events JOIN customer ON c_custkey = user_id "
            "UNION ALL SELECT 'artists', count(DISTINCT event_type) FROM events "
            f"UNION ALL SELECT 'time', count(DISTINCT {_SECONDS}) FROM events "
            "UNION ALL SELECT 'user_listens', count(*) FROM events WHERE event_id % 8 <> 0"
        ),
        "etl_published": (
            "SELECT 'users' AS name, count(DISTINCT c_name) AS n FROM events JOIN customer ON c_custkey = user_id "
            "UNION ALL SELECT 'artists', count(DISTINCT event_type) FROM events "
            f"UNION ALL SELECT 'time', count(DISTINCT {_SECONDS}) FROM events "
            "UNION ALL SELECT 'user_listens', count(*) FROM events WHERE event_id % 8 <> 0"
        ),
        "etl_fact": _FACT,
        "etl_users_on_day": f"{on_day} AND event_id % 8 <> 0",
        "etl_top_days": (
            "SELECT sha256(c_name) AS user, n AS number_of_listens, d AS date FROM (SELECT c_name, CAST(ts AS DATE) AS d, count(*) AS n "
            "FROM events JOIN customer ON c_custkey = user_id WHERE event_id % 8 <> 0 GROUP BY ALL) "
            "QUALIFY dense_rank() OVER (PARTITION BY c_name ORDER BY n DESC) < 4"
        ),
        "type_conformance": (
            "SELECT event_id, CASE WHEN event_id % 7 <> 5 THEN CAST(event_id AS INTEGER) END AS amount FROM events WHERE event_id % 7 NOT IN (1, 3)"
        ),
        "blank_texts": (
            "SELECT o_orderkey, 'o_orderpriority: blank' AS reasons FROM orders WHERE o_orderkey % 5 IN (0, 1)"
        ),
        "stream_enrich": _lake_sql(),
        "stream_dedupe": (
            f"SELECT CASE WHEN event_id % 10 <> 0 THEN CAST(event_id AS VARCHAR) END AS event_uuid, {_TYPE} AS event_type FROM events "
            f"UNION ALL SELECT NULL, {_TYPE} FROM events WHERE event_id % 10 = 0"
        ),
        "stream_errors": _ERRORS,
        "q_top_users": top_users,
        "q_users_on_day": on_day,
        "q_users_on_day_joined": on_day,
        "q_user_song": edge_song("first(event_type ORDER BY ts DESC, event_id)"),
        "q_user_first_song": edge_song("first(event_type ORDER BY ts, event_id)"),
        "q_top_days": best_days,
        "q_top_days_joined": best_days,
        "q_daily_active": active_by_listen,
        "q_daily_active_7day": active_by_day,
        "sql_top_users": top_users,
        "sql_users_on_day": on_day,
        "sql_latest_song": edge_song("first(event_type ORDER BY ts DESC, event_id)"),
        "sql_first_song": edge_song("first(event_type ORDER BY ts, event_id)"),
        "sql_top_days": best_days,
        "sql_daily_active": active_by_listen,
        "sql_daily_active_7day": active_by_day,
    }
