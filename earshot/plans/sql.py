"""The analyses as Spark SQL, for those who query the tables directly.

    spark.sql(SQL["top_users"], user_listens=..., users=..., time=...)

The texts name the star tables in braces; ``analysis`` fills in the stored ones.
``$date`` is the date of a listen and ``$first``, ``$last`` bound a day; they
follow from ``listen_time`` and its type, so no text joins the fact with
``time``, and a day reaches the scan as a range. As in ``analyses``, everything
per user and date starts from daily counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from earshot.sources.tables import star_tables

_DAYS = """
    days AS (
        SELECT user_id, $date AS date, unix_date($date) AS day_number, count(listen_id) AS listens
        FROM {user_listens}
        GROUP BY user_id, $date
    )"""

SQL = {
    "top_users": """
        SELECT u.user_name
        FROM {users} AS u
        JOIN (
            SELECT user_id, count(listen_id) AS listens FROM {user_listens}
            GROUP BY user_id ORDER BY listens DESC, user_id LIMIT 10
        ) AS top USING (user_id)""",
    "users_on_day": """
        SELECT count(DISTINCT user_id) AS user_count
        FROM {user_listens}
        WHERE listen_time >= $first AND listen_time < $last""",
    "latest_song": """
        SELECT song_name, user_name
        FROM (
            SELECT user_id, song_name,
                   row_number() OVER (PARTITION BY user_id ORDER BY listen_time DESC, listen_id) AS place
            FROM {user_listens}
        ) JOIN {users} USING (user_id)
        WHERE place = 1""",
    "first_song": """
        SELECT song_name, user_name
        FROM (
            SELECT user_id, song_name,
                   row_number() OVER (PARTITION BY user_id ORDER BY listen_time NULLS LAST, listen_id) AS place
            FROM {user_listens}
        ) JOIN {users} USING (user_id)
        WHERE place = 1""",
    "top_days": f"""
        WITH {_DAYS},
        ranked AS (
            SELECT *, dense_rank() OVER (PARTITION BY user_id ORDER BY listens DESC) AS place FROM days
        )
        SELECT user_id AS user, listens AS number_of_listens, date
        FROM ranked WHERE place <= 3
        ORDER BY user, number_of_listens DESC, date""",
    "daily_active_7day": f"""
        WITH {_DAYS},
        steps AS (
            SELECT user_id, date, lag(date, 6) OVER (PARTITION BY user_id ORDER BY date) AS sixth FROM days
        )
        SELECT date AS active_date,
               count(user_id) AS number_of_active_users,
               count(user_id) / (SELECT count(DISTINCT user_id) FROM {{users}}) * 100 AS percentage_active_users
        FROM steps WHERE datediff(date, sixth) = 6
        GROUP BY date ORDER BY active_date""",
    # one row per active user and date, see analyses.active_days_by_listen
    "daily_active": f"""
        WITH {_DAYS},
        running AS (
            SELECT *, sum(listens) OVER (PARTITION BY user_id ORDER BY day_number) AS upto FROM days
        ),
        places AS (
            SELECT *, sum(upto) OVER then AS then_upto, sum(listens) OVER then AS then_listens
            FROM running
            WINDOW then AS (PARTITION BY user_id ORDER BY day_number RANGE BETWEEN 6 PRECEDING AND 6 PRECEDING)
        ),
        active AS (
            SELECT date, pmod(xxhash64(user_id), 1024) AS part, count(user_id) AS here
            FROM places
            WHERE upto - listens - 5 <= then_upto AND then_upto - then_listens + 1 <= upto - 6
            GROUP BY ALL
        ),
        totals AS (SELECT *, sum(here) OVER (PARTITION BY date) AS users_of_date FROM active)
        SELECT date AS active_date,
               users_of_date AS number_of_active_users,
               users_of_date / (SELECT count(DISTINCT user_id) FROM {{users}}) * 100 AS percentage_active_users
        FROM totals LATERAL VIEW explode(sequence(1, here)) AS copy
        ORDER BY active_date, part, copy""",
}


def typed(text: str, listen_time: T.DataType) -> str:
    """The text with its date and bounds spelled out for epoch seconds, TIMESTAMP_NTZ or TIMESTAMP."""
    first, last = "make_date(:year, :month, :day)", "date_add(make_date(:year, :month, :day), 1)"
    if isinstance(listen_time, T.TimestampNTZType):
        date, bound = "CAST(listen_time AS DATE)", "CAST({} AS TIMESTAMP_NTZ)"
    elif isinstance(listen_time, T.TimestampType):
        date, bound = "CAST(listen_time AS DATE)", "CAST({} AS TIMESTAMP)"
    else:
        date, bound = "date_from_unix_date(CAST(floor(listen_time / 86400) AS INT))", "unix_date({}) * 86400L"
    return text.replace("$date", date).replace("$first", bound.format(first)).replace("$last", bound.format(last))


def run_sql(spark: SparkSession, name: str, tables: dict[str, DataFrame], **args) -> DataFrame:
    """Run one text on the given tables; ``args`` are its named parameters."""
    used = {t: df for t, df in tables.items() if f"{{{t}}}" in SQL[name]}
    return spark.sql(typed(SQL[name], tables["user_listens"].schema["listen_time"].dataType), args=args, **used)


def analysis(spark: SparkSession, name: str, database: str, **args) -> DataFrame:
    """Run one text on the stored tables of a database."""
    return run_sql(spark, name, star_tables(spark, database), **args)
