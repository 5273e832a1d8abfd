"""From raw listens to the frames of the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot import schemas as S
from earshot.functions.calendar import date_parts, day_name, wall_clock
from earshot.functions.events import MAX_SECOND, MIN_SECOND
from earshot.functions.text import hash_key
from earshot.operators.dedupe import distinct_first
from earshot.sources.listens import ORDINAL


def select_renamed(df: DataFrame, paths: dict[str, str], *extra: str) -> DataFrame:
    """Project source paths to columns."""
    return df.select(*[F.col(path).alias(name) for path, name in paths.items()], *extra)


def users_frame(listens: DataFrame) -> DataFrame:
    """Distinct users. The key is hashed after the distinct, once per user."""
    users = distinct_first(select_renamed(listens, S.USER_PATHS, ORDINAL), ORDINAL)
    return users.withColumn("user_id", hash_key(F.col("user_name")))


def artists_frame(listens: DataFrame) -> DataFrame:
    """Distinct pairs of artist id and name."""
    return distinct_first(select_renamed(listens, S.ARTIST_PATHS, ORDINAL), ORDINAL)


def calendar_columns(seconds: Column) -> dict[str, Column]:
    """The columns of ``time`` that follow from the epoch seconds."""
    ts = wall_clock(F.when(seconds.between(MIN_SECOND, MAX_SECOND), seconds))
    return {"timestamp": ts, "date": F.to_date(ts), **date_parts(ts), "day_name": day_name(ts)}


def time_frame(listens: DataFrame) -> DataFrame:
    """Distinct listening times with their calendar, derived after the distinct."""
    times = distinct_first(select_renamed(listens, S.TIME_PATHS, ORDINAL), ORDINAL)
    return times.withColumns(calendar_columns(F.col("listen_time").try_cast("bigint")))


def listens_frame(listens: DataFrame) -> DataFrame:
    """One row per raw listen, the user given by key.

    Equal rows share their ``listen_id``, so keeping the first row per id in
    validation also removes exact copies, in the same shuffle.
    """
    fact = select_renamed(listens, S.LISTEN_PATHS, ORDINAL)
    return fact.withColumn("user_id", hash_key(F.col("user_name"))).drop("user_name")


# Each table's frame before validation, with its ordinal.
STAR_FRAMES = {
    "users": users_frame,
    "artists": artists_frame,
    "time": time_frame,
    "user_listens": listens_frame,
}
