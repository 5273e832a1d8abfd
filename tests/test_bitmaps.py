import datetime as dt
import random

import pytest

from earshot.operators.bitmaps import day_bitmaps, dense_numbers, distinct_between, distinct_rolling

DAY = dt.date(2024, 2, 20)


@pytest.fixture(scope="module")
def visits(spark):
    draw = random.Random(4)
    rows = [(draw.choice([None, *range(300), 7, 7, 7]), draw.choice([None, *[DAY + dt.timedelta(days=k) for k in range(40) if k % 9]])) for _ in range(3000)]
    data = [(None if u is None else f"u{u}", d) for u, d in rows]
    return spark.createDataFrame(data, "user_id string, date date"), data


def want(data, first, last):
    return len({u for u, d in data if u is not None and d is not None and first <= d <= last})


def test_numbers_have_no_gaps_and_stay(visits):
    df, data = visits
    some = dense_numbers(df.where("user_id < 'u2'"), "user_id")
    every = dense_numbers(df, "user_id", known=some)
    users = {u for u, _ in data if u is not None}
    found = {r.user_id: r.number for r in every.collect()}
    assert set(found) == users and sorted(found.values()) == list(range(1, len(users) + 1))
    assert {r.user_id: r.number for r in some.collect()}.items() <= found.items()
    assert dense_numbers(df, "user_id", known=every).count() == len(users)


def test_ranges_equal_the_distinct_users(visits):
    df, data = visits
    bitmaps = day_bitmaps(df, dense_numbers(df, "user_id"), "user_id", "date").cache()
    for first, length in ((0, 1), (3, 7), (0, 30), (9, 1), (39, 5), (50, 9)):
        a, b = DAY + dt.timedelta(days=first), DAY + dt.timedelta(days=first + length - 1)
        assert distinct_between(bitmaps, a, b).first().n == want(data, a, b)
    for days in (1, 7, 30):
        found = {r.date: r.n for r in distinct_rolling(bitmaps, days).collect()}
        dates = {d for u, d in data if u is not None and d is not None}
        assert found == {d: want(data, d - dt.timedelta(days=days - 1), d) for d in dates}


def test_many_numbers_take_several_buckets(spark):
    rows = spark.range(100_000).selectExpr("id", "date'2024-01-01' + int(id % 3) AS day")
    bitmaps = day_bitmaps(rows, dense_numbers(rows, "id"), "id", "day")
    assert bitmaps.count() == 12
    assert sorted((str(r.date), r.n) for r in distinct_rolling(bitmaps, 2).collect()) == [
        ("2024-01-01", 33_334), ("2024-01-02", 66_667), ("2024-01-03", 66_666)
    ]


def test_empty(spark):
    rows = spark.createDataFrame([], "user_id string, date date")
    bitmaps = day_bitmaps(rows, dense_numbers(rows, "user_id"), "user_id", "date")
    assert distinct_rolling(bitmaps, 7).count() == 0 and distinct_between(bitmaps, DAY, DAY).first().n == 0
