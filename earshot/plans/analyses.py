"""The analyses of the listening history.

``listens`` and ``users`` are the star tables. ``listen_time`` may be epoch
seconds, as stored, or a timestamp. Where a question needs the date of a listen,
it follows from ``listen_time``; every listen has its row in ``time``, so joining
that table, nearly as long as the fact, adds nothing. Pass ``time`` to join it
nevertheless, for instance with a calendar of your own.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.functions.calendar import listen_moment, newest_first, within_day
from earshot.operators.dedupe import first_values
from earshot.operators.grouping import distinct_total, group_count, percent_of

SLICES = 1024
"""Parts in which the users of a date are counted and listed."""


def dated(listens: DataFrame, time: DataFrame | None = None) -> DataFrame:
    """Listens with their ``date``."""
    if time is not None:
        return listens.join(time.select("listen_time", "date"), "listen_time")
    moment = listen_moment(F.col("listen_time"), listens.schema["listen_time"].dataType)
    return listens.withColumn("date", F.to_date(moment))


def user_days(listens: DataFrame, time: DataFrame | None = None) -> DataFrame:
    """Listens per user and date. All that follows works on these counts: a user,
    however heavy, has no more rows than there are dates."""
    return group_count(dated(listens, time), ["user_id", "date"], "listen_id", "listen_count")


def top_users(listens: DataFrame, users: DataFrame, n: int = 10) -> DataFrame:
    """Names of the ``n`` users with the most listens; ties go by user id."""
    counts = group_count(listens, "user_id", "listen_id", "listen_count")
    top = counts.orderBy(F.desc("listen_count"), "user_id").limit(n)
    # n rows, so the users are filtered where they are
    return users.join(F.broadcast(top), "user_id").select("user_name")


def users_on_day(
    listens: DataFrame, day: date, time: DataFrame | None = None, approximate: bool = False
) -> DataFrame:
    """Number of distinct users with a listen on ``day``.

    The day is a range of ``listen_time``, which both scans can skip by.
    """
    dtype = listens.schema["listen_time"].dataType
    on_day = within_day(F.col("listen_time"), dtype, day)
    found = listens.where(on_day)
    if time is not None:
        parts = (F.col("year") == day.year) & (F.col("month") == day.month) & (F.col("day") == day.day)
        times = time.where(on_day & parts).select("listen_time")
        if isinstance(dtype, T.LongType):
            times = F.broadcast(times.distinct())  # whole seconds: a day has at most 86,400
        found = found.join(times, "listen_time", "left_semi")
    return distinct_total(found, "user_id", approximate).withColumnRenamed("n", "user_count")


def latest_song(listens: DataFrame, users: DataFrame) -> DataFrame:
    """Each user's most recent song, which is what the original query returns."""
    dtype = listens.schema["listen_time"].dataType
    order = [F.col("listen_time").isNull(), newest_first(F.col("listen_time"), dtype), F.col("listen_id")]
    picked = first_values(listens, "user_id", order, ["song_name"])
    return picked.join(users, "user_id").select("song_name", "user_name")


def first_song(listens: DataFrame, users: DataFrame) -> DataFrame:
    """Each user's first song, which is what the question asks for."""
    picked = first_values(listens, "user_id", [F.col("listen_time"), F.col("listen_id")], ["song_name"])
    return picked.join(users, "user_id").select("song_name", "user_name")


def top_days(listens: DataFrame, time: DataFrame | None = None, ranks: int = 3) -> DataFrame:
    """Days of each user within the ``ranks`` highest daily counts, ties included."""
    by_count = W.partitionBy("user_id").orderBy(F.desc("listen_count"))
    ranked = user_days(listens, time).withColumn("listen_rank", F.dense_rank().over(by_count))
    return (
        ranked.where(F.col("listen_rank") <= ranks)
        .select(
            F.col("user_id").alias("user"), F.col("listen_count").alias("number_of_listens"), "date"
        )
        .orderBy(F.asc("user"), F.desc("number_of_listens"), F.asc("date"))
    )


def active_days_by_listen(listens: DataFrame, time: DataFrame | None = None) -> DataFrame:
    """User and date pairs with some listen whose sixth predecessor, among the
    user's listens in date order, lies exactly six days back.

    Sorted by date, the listens of one day hold consecutive places. A day ends
    at place ``upto`` and starts after ``upto - listens``. Shifted six places
    back, today's places must meet those of the day six days ago. Counts per day
    decide that, so the listens themselves are never sorted or shuffled.
    """
    by_day = W.partitionBy("user_id").orderBy("day_number")
    # the frame that holds the single row of the date six days ago, if any
    six_days_ago = by_day.rangeBetween(-6, -6)
    places = (
        user_days(listens, time)
        .where(F.col("date").isNotNull())
        .withColumn("day_number", F.unix_date("date"))
        .withColumn("upto", F.sum("listen_count").over(by_day.rowsBetween(W.unboundedPreceding, 0)))
        .withColumn("then_upto", F.sum("upto").over(six_days_ago))
        .withColumn("then_count", F.sum("listen_count").over(six_days_ago))
    )
    today_from = F.col("upto") - F.col("listen_count") + 1 - 6
    today_upto = F.col("upto") - 6
    then_from = F.col("then_upto") - F.col("then_count") + 1
    meets = (today_from <= F.col("then_upto")) & (then_from <= today_upto)
    return places.where(meets).select("user_id", F.col("date").alias("active_date"))


def active_days_by_day(listens: DataFrame, time: DataFrame | None = None) -> DataFrame:
    """User and date pairs where the user listened on each of the last seven days:
    the sixth previous listening day lies exactly six days back."""
    days = dated(listens, time).select("user_id", "date").distinct()
    sixth = F.lag("date", 6).over(W.partitionBy("user_id").orderBy("date"))
    active = days.withColumn("six_before", sixth).where(F.datediff("date", "six_before") == 6)
    return active.select("user_id", F.col("date").alias("active_date"))


def daily_active(listens: DataFrame, users: DataFrame, time: DataFrame | None = None) -> DataFrame:
    """Active users per date and their share of all users, **one row per active
    user and date** as in the original query.

    Users are counted in slices of a date, the counts are summed over the few
    rows of a date, and each slice then lists its own rows. So no date is
    gathered in one task, nor is it sorted in one.
    """
    active = active_days_by_listen(listens, time)
    part = F.pmod(F.xxhash64("user_id"), F.lit(SLICES))
    slices = active.groupBy("active_date", part.alias("part")).agg(F.count("user_id").alias("here"))
    on_date = F.sum("here").over(W.partitionBy("active_date"))
    totals = slices.withColumn("number_of_active_users", on_date)
    rows = totals.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("here"))))
    return (
        rows.orderBy("active_date", "part", "copy")
        .select("active_date", "number_of_active_users")
        .withColumn(
            "percentage_active_users",
            percent_of(F.col("number_of_active_users"), distinct_total(users, "user_id")),
        )
    )


def daily_active_7day(listens: DataFrame, users: DataFrame, time: DataFrame | None = None) -> DataFrame:
    """Users active on seven days in a row, and their share, one row per date."""
    counts = group_count(active_days_by_day(listens, time), "active_date", "user_id", "number_of_active_users")
    share = percent_of(F.col("number_of_active_users"), distinct_total(users, "user_id"))
    return counts.withColumn("percentage_active_users", share).orderBy("active_date")
