"""Fixed schemas: the raw listening log, the star tables and the event lake."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: source path -> column, per star table ---------------------

USER_PATHS = {"user_name": "user_name"}
ARTIST_PATHS = {
    "track_metadata.additional_info.artist_msid": "artist_id",
    "track_metadata.artist_name": "artist_name",
}
TIME_PATHS = {"listened_at": "listen_time"}
LISTEN_PATHS = {
    "user_name": "user_name",
    "recording_msid": "listen_id",
    "listened_at": "listen_time",
    "track_metadata.track_name": "song_name",
    "track_metadata.release_name": "album_name",
    "track_metadata.additional_info.artist_msid": "artist_id",
}

REQUIRED_PATHS = sorted({*USER_PATHS, *ARTIST_PATHS, *TIME_PATHS, *LISTEN_PATHS})

# --- raw listening log ---------------------------------------------------------

# Only what the star schema uses: the JSON reader skips every other field. All
# leaves are read as text so that a badly typed value rejects its own row in
# validation instead of ending the read.
RAW_LISTEN = T.StructType(
    [
        T.StructField("user_name", T.StringType()),
        T.StructField("recording_msid", T.StringType()),
        T.StructField("listened_at", T.StringType()),
        T.StructField(
            "track_metadata",
            T.StructType(
                [
                    T.StructField("track_name", T.StringType()),
                    T.StructField("release_name", T.StringType()),
                    T.StructField("artist_name", T.StringType()),
                    T.StructField(
                        "additional_info",
                        T.StructType([T.StructField("artist_msid", T.StringType())]),
                    ),
                ]
            ),
        ),
    ]
)

# --- star tables; fixed values: table and column names, types ---------------------------------------------------------------

USERS = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("user_name", T.StringType()),
    ]
)
ARTISTS = T.StructType(
    [
        T.StructField("artist_id", T.StringType()),
        T.StructField("artist_name", T.StringType()),
    ]
)
TIME = T.StructType(
    [
        T.StructField("listen_time", T.LongType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("date", T.DateType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
        T.StructField("day_name", T.StringType()),
        T.StructField("hour", T.IntegerType()),
    ]
)
USER_LISTENS = T.StructType(
    [
        T.StructField("listen_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("listen_time", T.LongType()),
        T.StructField("artist_id", T.StringType()),
        T.StructField("song_name", T.StringType()),
        T.StructField("album_name", T.StringType()),
    ]
)

# Parents come before the fact: this is also the order of loading.
STAR_TABLES = {"users": USERS, "artists": ARTISTS, "time": TIME, "user_listens": USER_LISTENS}

# Columns whose values must be unique within a table, the primary key first.
UNIQUE_COLUMNS = {
    "users": ["user_id", "user_name"],
    "artists": ["artist_id"],
    "time": ["listen_time"],
    "user_listens": ["listen_id"],
}

# Fact column -> parent table (the parent's key has the same name).
LISTEN_PARENTS = {"user_id": "users", "listen_time": "time", "artist_id": "artists"}

# --- events ----------------------------------------------------------------------

ENVELOPE = T.StructType(
    [
        T.StructField("recordId", T.StringType()),
        T.StructField("data", T.StringType()),
    ]
)

# fixed values: column names and types of the lake
LAKE_EVENT = T.StructType(
    [
        T.StructField("event_uuid", T.StringType()),
        T.StructField("event_name", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("created_datetime", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("event_subtype", T.StringType()),
    ]
)
PARTITION_KEYS = ["year", "month", "day", "hour"]


def ddl(schema: T.StructType) -> str:
    """Column list for a CREATE TABLE statement."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
