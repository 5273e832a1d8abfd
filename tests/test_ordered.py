import datetime as dt
import random
from pathlib import Path

import pytest
from fixtures import rows
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from earshot.operators import ordered
from earshot.operators.grouping import with_group_count
from earshot.operators.ordered import heavy_keys, lagged, row_numbers

KINDS = {
    "bigint": lambda rng: rng.randint(0, 20),
    "timestamp_ntz": lambda rng: dt.datetime(2024, 3, 10, 1, 0) + dt.timedelta(seconds=rng.randint(0, 9000) / 2),
    "timestamp": lambda rng: dt.datetime(2024, 3, 10, 1, 0) + dt.timedelta(seconds=rng.randint(0, 9000) / 2),
    "date": lambda rng: dt.date(2024, 3, 1) + dt.timedelta(days=rng.randint(0, 9)),
    "double": lambda rng: rng.randint(-40, 40) / 4,
}


def frame(spark, kind, n=300):
    """One key holds a third of the rows, another is null; times repeat and may be null."""
    rng = random.Random(kind)
    make = KINDS[kind]
    data = [
        (rng.choice([1, 1, None, 2, 3, 4]), rng.choice([make(rng)] * 9 + [None]), i, f"v{rng.randint(0, 50)}")
        for i in range(n)
    ]
    return spark.createDataFrame(data, f"k int, t {kind}, id int, v string")


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("newest_first", [False, True])
def test_row_numbers_equal_the_plain_window(spark, kind, newest_first):
    df = frame(spark, kind)
    head = F.desc("t") if newest_first else F.asc("t")
    plain = df.withColumn("rn", F.row_number().over(W.partitionBy("k").orderBy(head, "id")).cast("bigint"))
    expected = rows(plain)
    for max_rows in (60, 10**6):
        assert rows(row_numbers(df, "k", "t", ["id"], "rn", newest_first, max_rows)) == expected


@pytest.mark.parametrize("kind", ["bigint", "timestamp_ntz"])
def test_lag_equals_the_plain_window(spark, kind):
    df = frame(spark, kind)
    expected = rows(df.withColumn("p", F.lag("v", 6).over(W.partitionBy("k").orderBy("t", "id"))))
    for max_rows in (0, 60, 10**6):
        assert rows(lagged(df, "k", "t", ["id"], "v", 6, "p", max_rows)) == expected


@pytest.mark.parametrize("moment", [7, None])
def test_one_second_or_null_times_only_are_cut_too(spark, moment, monkeypatch):
    df = spark.range(1000).selectExpr("1 as k", "cast(null as bigint) as t" if moment is None else f"{moment}L as t", "id", "cast(id as string) as v")
    sizes = []
    stage = ordered.staged

    def watched(frame, path):
        kept = stage(frame, path)
        sizes.extend(r[0] for r in kept.groupBy("_slice").count().select("count").collect())
        return kept

    monkeypatch.setattr(ordered, "staged", watched)
    numbered = row_numbers(df, "k", "t", ["id"], "rn", max_rows=100)
    assert [(r.id, r.rn) for r in numbered.orderBy("id").collect()] == [(i, i + 1) for i in range(1000)]
    assert len(sizes) > 10 and max(sizes) <= 200
    behind = lagged(df, "k", "t", ["id"], "v", 6, "p", max_rows=100)
    assert [r.p for r in behind.orderBy("id").collect()] == [None] * 6 + [str(i) for i in range(994)]


def test_heavy_keys(spark):
    keys, n = heavy_keys(frame(spark, "bigint"), "k", 60)
    assert n == 1 and keys.first()[0] == 1


def test_count_of_group_on_rows(spark):
    df = frame(spark, "bigint")
    expected = rows(df.withColumn("n", F.count("t").over(W.partitionBy("k"))))
    assert rows(with_group_count(df, "k", "t", "n")) == expected


@pytest.mark.parametrize("offset", [1, 6, 40])
def test_slices_shorter_than_the_lag(spark, offset):
    """Slices of a few rows, nulls among the values, and a plan that joins no rows with themselves."""
    df = frame(spark, "bigint").withColumn("v", F.when(F.col("id") % 3 > 0, F.col("v")))
    expected = rows(df.withColumn("p", F.lag("v", offset).over(W.partitionBy("k").orderBy("t", "id"))))
    cut = lagged(df, "k", "t", ["id"], "v", offset, "p", max_rows=8)
    assert rows(cut) == expected


def test_a_lag_of_heavy_keys_reads_the_slices_once(spark):
    df = frame(spark, "bigint")
    plan = lagged(df, "k", "t", ["id"], "v", 6, "p", max_rows=60)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("/slices-") + plan.count("_slice#") > 0 and plan.count("parquet") == 1


@pytest.mark.parametrize("function", ["row_numbers", "lagged"])
def test_tasks_follow_the_rows_and_not_the_slices(spark, function, monkeypatch):
    """Thousands of small slices are cut by a few tasks; each key's slices are small and in order."""
    df = spark.range(6000).selectExpr("id % 50 AS k", "id % 7 AS t", "id", "cast(id AS string) AS v")
    kept = []
    stage = ordered.staged
    monkeypatch.setattr(ordered, "staged", lambda frame, path: kept.append((stage(frame, path), path)) or kept[-1][0])
    if function == "row_numbers":
        found = row_numbers(df, "k", "t", ["id"], "out", max_rows=6)
        plain = F.row_number().over(W.partitionBy("k").orderBy("t", "id")).cast("bigint")
    else:
        found = lagged(df, "k", "t", ["id"], "v", 6, "out", max_rows=6)
        plain = F.lag("v", 6).over(W.partitionBy("k").orderBy("t", "id"))
    assert rows(found) == rows(df.withColumn("out", plain))
    [(slices, path)] = kept
    assert 1 < len(list(Path(path).glob("part-*"))) <= spark.sparkContext.defaultParallelism
    sizes = [r["count"] for r in slices.groupBy("_slice").count().collect()]
    assert len(sizes) >= 2000 and max(sizes) <= 3
    ends = slices.groupBy("k", "_slice").agg(F.min(F.struct("t", "id")).alias("low"), F.max(F.struct("t", "id")).alias("high"))
    after = F.lag("high").over(W.partitionBy("k").orderBy("_slice"))
    assert ends.withColumn("before", after).where("before >= low").count() == 0
