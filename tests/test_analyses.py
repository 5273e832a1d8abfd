import datetime as dt
import random

import pytest
from fixtures import rows
from pyspark.sql import functions as F

from earshot.plans import analyses as A
from earshot.plans.star import calendar_columns

START = 1546300800  # 2019-01-01


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    """Users of very unequal weight, with gaps of days and days of many listens."""
    rng = random.Random(7)
    listens = []
    for user, n in {"a": 400, "b": 60, "c": 40, "d": 7, "e": 1}.items():
        for _ in range(n):
            when = START + rng.randint(0, 19) * 86400 + rng.randint(0, 86399)
            listens.append((f"l{len(listens):05d}", user, when, f"song {rng.randint(0, 9)}"))
    # exactly one listen per day for ten days; and seven listens with a six-day step
    listens += [(f"m{i}", "f", START + i * 86400, "s") for i in range(10)]
    listens += [(f"n{i}", "g", START + (6 if i == 6 else 0) * 86400 + i, "s") for i in range(7)]
    fact = spark.createDataFrame(listens, "listen_id string, user_id string, listen_time bigint, song_name string")
    users = spark.createDataFrame([(u, f"name {u}") for u in "abcdefgh"], "user_id string, user_name string")
    time = fact.select("listen_time").distinct().withColumns(calendar_columns(F.col("listen_time")))
    return fact.cache(), users.cache(), time.cache(), listens


def day(seconds):
    return dt.datetime.fromtimestamp(seconds, dt.timezone.utc).date()


def test_daily_active_as_written(star):
    fact, users, time, listens = star
    active = set()
    for user in {u for _, u, _, _ in listens}:
        dates = sorted(day(t) for _, u, t, _ in listens if u == user)
        active |= {(user, d) for d, e in zip(dates[6:], dates) if (d - e).days == 6}
    assert active
    assert set(rows(A.active_days_by_listen(fact))) == active
    per_day = {}
    for _, d in active:
        per_day[d] = per_day.get(d, 0) + 1
    expected = sorted((d, n, n / 8 * 100) for d, n in per_day.items() for _ in range(n))
    for given in (None, time):
        assert [tuple(r) for r in A.daily_active(fact, users, given).collect()] == expected


def test_daily_active_by_days(star):
    fact, users, time, listens = star
    per_day = {}
    for user in {u for _, u, _, _ in listens}:
        dates = sorted({day(t) for _, u, t, _ in listens if u == user})
        for d, e in zip(dates[6:], dates):
            if (d - e).days == 6:
                per_day[d] = per_day.get(d, 0) + 1
    expected = sorted((d, n, n / 8 * 100) for d, n in per_day.items())
    for given in (None, time):
        assert [tuple(r) for r in A.daily_active_7day(fact, users, given).collect()] == expected


def test_top_days(star):
    fact, _, time, listens = star
    counts = {}
    for _, u, t, _ in listens:
        counts[u, day(t)] = counts.get((u, day(t)), 0) + 1
    expected = []
    for user in {u for u, _ in counts}:
        best = sorted({n for (u, _), n in counts.items() if u == user}, reverse=True)[:3]
        expected += [(u, n, d) for (u, d), n in counts.items() if u == user and n in best]
    expected.sort(key=lambda r: (r[0], -r[1], r[2]))
    for given in (None, time):
        assert [tuple(r) for r in A.top_days(fact, given).collect()] == expected


def test_songs(star):
    fact, users, _, listens = star
    for pick, analysis in ((max, A.latest_song), (min, A.first_song)):
        expected = []
        for user in {u for _, u, _, _ in listens}:
            edge = pick(t for _, u, t, _ in listens if u == user)
            first_id = min(i for i, u, t, _ in listens if (u, t) == (user, edge))
            expected.append((next(s for i, _, _, s in listens if i == first_id), f"name {user}"))
        assert rows(analysis(fact, users)) == sorted(expected, key=repr)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_songs_by_timestamp(spark, star, kind):
    fact, users, _, _ = star
    stamped = fact.withColumn("listen_time", F.timestamp_seconds("listen_time").cast(kind))
    assert rows(A.latest_song(stamped, users)) == rows(A.latest_song(fact, users))
    assert rows(A.first_song(stamped, users)) == rows(A.first_song(fact, users))
    assert rows(A.users_on_day(stamped, dt.date(2019, 1, 5))) == rows(A.users_on_day(fact, dt.date(2019, 1, 5)))


def test_users_on_day(star):
    fact, _, time, listens = star
    expected = len({u for _, u, t, _ in listens if day(t) == dt.date(2019, 1, 5)})
    for given in (None, time):
        assert A.users_on_day(fact, dt.date(2019, 1, 5), given).first()[0] == expected
    assert A.users_on_day(fact, dt.date(2019, 1, 5), approximate=True).first()[0] > 0


def test_top_users(star):
    fact, users, _, listens = star
    assert rows(A.top_users(fact, users, 2)) == [("name a",), ("name b",)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark, star, tmp_path):
    fact, users, time, _ = star
    for name, df in {"fact": fact, "users": users, "time": time}.items():
        df.write.parquet(f"{tmp_path}/{name}")
    fact, users, time = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("fact", "users", "time"))

    on_day = plan_of(A.users_on_day(fact, dt.date(2019, 1, 5), time))
    assert on_day.count("GreaterThanOrEqual(listen_time") == 2  # the range reaches both scans
    assert "BroadcastHashJoin" in on_day

    top = plan_of(A.top_users(fact, users))
    assert "TakeOrderedAndProject" in top and "BroadcastHashJoin" in top
    assert "ReadSchema: struct<listen_id:string,user_id:string>" in top

    song = plan_of(A.latest_song(fact, users))
    assert "partial_min" in song  # one row per user leaves each task

    days = plan_of(A.top_days(fact))
    assert "partial_count" in days[days.index("WindowGroupLimit"):]

    active = plan_of(A.active_days_by_listen(fact))
    assert "partial_count" in active and "song_name" not in active
    assert active.count("Exchange hashpartitioning") == 2
    assert active.count("Sort [") == 1
