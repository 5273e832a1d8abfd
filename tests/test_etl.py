import random
import runpy
import sys

import pytest
from fixtures import (
    ARTIST,
    ARTISTS_EXPECTED,
    LISTENS_EXPECTED,
    TIME_EXPECTED,
    USERS_EXPECTED,
    lines,
    listen,
    records,
    rows,
    write_text,
    write_zip,
)
from pyspark.sql import functions as F

from earshot import schemas as S
from earshot.errors import MissingDataException, OrphanRowsError
from earshot.operators.integrity import orphans, quarantine_orphans
from earshot.operators.sizing import discard
from earshot.operators.upsert import new_rows
from earshot.plans.etl import rejected_table, run_etl, transform, valid_table
from earshot.plans.load import load
from earshot.plans.rules import STAR_RULES
from earshot.sources.listens import ORDINAL, extract, numbered
from earshot.sources.tables import create_star_tables, list_tables, star_tables

EXPECTED = {
    "users": USERS_EXPECTED,
    "artists": ARTISTS_EXPECTED,
    "time": TIME_EXPECTED,
    "user_listens": LISTENS_EXPECTED,
}


@pytest.fixture
def database(spark, tmp_path):
    name = f"star_{tmp_path.name.replace('-', '_')}"
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def stored(spark, database):
    return {n: rows(t.select(*S.STAR_TABLES[n].names)) for n, t in star_tables(spark, database).items()}


def test_create_tables_twice(spark, database):
    create_star_tables(spark, database)
    create_star_tables(spark, database)
    assert list_tables(spark, database) == ["artists", "time", "user_listens", "users"]
    assert {n: t.schema for n, t in star_tables(spark, database).items()} == S.STAR_TABLES


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_transform(spark, tmp_path, zone):
    path = write_text(tmp_path / "listens.txt", lines(records()))
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        frames = transform(extract(spark, path))
        assert {n: rows(df.select(*S.STAR_TABLES[n].names)) for n, df in frames.items()} == EXPECTED
        for name, df in frames.items():
            assert {f.name: f.dataType for f in df.schema if f.name != ORDINAL} == {
                f.name: f.dataType for f in S.STAR_TABLES[name]
            }
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("kind, schema", [("txt", S.RAW_LISTEN), ("json", None), ("zip", S.RAW_LISTEN)])
def test_run_twice(spark, tmp_path, database, kind, schema):
    path = tmp_path / f"listens.{kind}"
    text = lines(records())
    path = write_zip(path, {"a.txt": text}) if kind == "zip" else write_text(path, text)
    for _ in range(2):
        result = run_etl(spark, path, database, schema)
        assert result.extracted == 3
        assert all(df.isEmpty() for df in result.rejected().values())
        result.discard()
        assert stored(spark, database) == EXPECTED


def test_command_line(spark, tmp_path, database, monkeypatch):
    path = write_text(tmp_path / "listens.txt", lines(records()))
    monkeypatch.setattr(sys, "argv", ["etl.py", path, database])
    runpy.run_module("earshot.plans.etl", run_name="__main__")
    assert stored(spark, database) == EXPECTED


def test_second_log_adds_only_what_is_new(spark, tmp_path, database):
    run_etl(spark, write_text(tmp_path / "a.txt", lines(records())), database).discard()
    changed = listen(1555286378, "283062c8-75e2-406a-8c5e-f38136aa5a68", "Another title")
    fresh = listen(1555290000, "new-id", "New song", user="Someone")
    run_etl(spark, write_text(tmp_path / "b.txt", lines([changed, fresh])), database).discard()
    now = stored(spark, database)
    assert len(now["users"]) == 2 and len(now["user_listens"]) == 4
    assert {r[4] for r in now["user_listens"]} == {r[4] for r in LISTENS_EXPECTED} | {"New song"}


def test_rejected_rows_do_not_reach_the_tables(spark, tmp_path, database):
    bad = [
        listen(1, "n1", "s", user=None),
        listen("later", "n2", "s"),
        listen(10**15, "n3", "s"),
        listen(1, "n4", None),
        listen(1, None, "s"),
    ]
    path = write_text(tmp_path / "mixed.txt", lines([*records(), *bad, *records()]))
    result = run_etl(spark, path, database, orphans="quarantine")
    reasons = {r["listen_id"]: list(r["reasons"]) for r in result.rejected()["user_listens"].collect()}
    assert reasons == {
        "n1": ["user_id: null"],
        "n2": ["listen_time: null", "listen_time: not bigint"],
        "n4": ["song_name: null"],
        None: ["listen_id: null"],
    }
    # its time is out of the calendar, so the listen lost its parent
    assert [tuple(r) for r in result.load.orphans.select("listen_id", "reasons").collect()] == [
        ("n3", ["listen_time: no parent"])
    ]
    assert stored(spark, database)["user_listens"] == LISTENS_EXPECTED
    result.discard()


def test_orphans_end_the_load_before_any_write(spark, tmp_path, database):
    path = write_text(tmp_path / "x.txt", lines([*records(), listen(10**15, "n3", "s")]))
    with pytest.raises(OrphanRowsError, match="listen_time"):
        run_etl(spark, path, database)
    assert all(not table for table in stored(spark, database).values())


def test_artist_without_name_orphans_its_listens(spark, tmp_path):
    path = write_text(tmp_path / "x.txt", lines([*records(), listen(5, "z", "s", artist="other", artist_name=None)]))
    frames = transform(extract(spark, path))
    assert rows(frames["artists"].select("artist_id")) == [(ARTIST,)]
    assert rows(orphans(frames["user_listens"], "artist_id", frames["artists"]).select("listen_id")) == [("z",)]
    relaxed = STAR_RULES | {"artists": STAR_RULES["artists"].allow_null("artist_name")}
    assert transform(extract(spark, path), relaxed)["artists"].count() == 2


def test_first_name_of_an_artist_stays(spark, tmp_path):
    data = [listen(i, f"l{i}", "s", artist_name=n) for i, n in enumerate(["B", "A", "B", "C"])]
    listens = extract(spark, write_text(tmp_path / "x.txt", lines(data)))
    assert rows(transform(listens)["artists"].select(*S.ARTISTS.names)) == [(ARTIST, "B")]
    names = rows(rejected_table(listens, "artists").select("artist_name"))
    assert names == [("A",), ("C",)]


def test_missing_fields(spark, tmp_path, database):
    short = write_text(tmp_path / "short.json", lines([{"user_name": "u", "listened_at": 1}]))
    for schema in (S.RAW_LISTEN, None):
        with pytest.raises(MissingDataException, match="recording_msid"):
            run_etl(spark, short, database, schema)


def test_bucketed_tables(spark, tmp_path, database):
    path = write_text(tmp_path / "listens.txt", lines(records()))
    for _ in range(2):
        run_etl(spark, path, database, buckets=4).discard()
    assert stored(spark, database) == EXPECTED
    detail = spark.sql(f"DESCRIBE TABLE EXTENDED {database}.user_listens").collect()
    assert ("Num Buckets", "4") in [(r[0], r[1]) for r in detail]


def test_load_rejects_unknown_option(spark, database):
    with pytest.raises(ValueError):
        load(spark, {}, database, orphans="ignore")


@pytest.mark.parametrize("batch_rows", [None, 4])
def test_new_rows_broadcast_and_shuffled(spark, batch_rows):
    batch = spark.createDataFrame([(1, "a", 0), (2, "b", 1), (2, "c", 2), (3, "d", 3)], "id int, name string, o int")
    target = spark.createDataFrame([(1, "zz"), (9, "d")], "id int, name string")
    got = new_rows(batch, target, ["id", "name"], "o", batch_rows)
    assert rows(got) == [(2, "b", 1)]


def one_by_one(batch, stored):
    """Insert-or-ignore in plain Python."""
    keys, names = {k for k, _ in stored}, {n for _, n in stored}
    out = []
    for _, k, n in sorted(batch):
        if k not in keys and n not in names:
            keys.add(k)
            names.add(n)
            out.append((k, n))
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
def test_two_unique_columns_as_if_stored_one_by_one(spark, seed):
    draw = random.Random(seed)
    batch = [(i, f"k{draw.randrange(8)}", f"n{draw.randrange(8)}") for i in range(20)]
    stored = [("k0", "taken"), ("k9", "n1")]
    made = new_rows(
        spark.createDataFrame(batch, "o long, k string, n string"), spark.createDataFrame(stored, "k string, n string"), ["k", "n"], "o"
    )
    assert sorted((r.k, r.n) for r in made.collect()) == one_by_one(batch, stored)


def test_a_taken_row_does_not_crowd_out_a_good_one(spark):
    batch = spark.createDataFrame([(1, "k1", "taken"), (2, "k1", "free")], "o long, k string, n string")
    stored = spark.createDataFrame([("k0", "taken")], "k string, n string")
    assert [(r.k, r.n) for r in new_rows(batch, stored, ["k", "n"], "o").collect()] == [("k1", "free")]


@pytest.mark.parametrize("text", ["", "[1]\n7\n"])
def test_a_log_without_any_field_is_missing_them_all(spark, tmp_path, database, text):
    (tmp_path / "log.txt").write_text(text)
    with pytest.raises(MissingDataException if not text else Exception):
        run_etl(spark, str(tmp_path / "log.txt"), database)


def test_cleanup_takes_uris_and_hides_no_error(spark, tmp_path):
    for i, form in enumerate(("{}", "file:{}", "file://{}")):
        folder = tmp_path / str(i)
        (folder / "x").mkdir(parents=True)
        discard(spark, form.format(folder))
        assert not folder.exists()
    discard(spark, "nosuch://a/b")


def test_the_stored_fact_is_in_order_of_time(spark, tmp_path, database):
    log = [listen(1555286378 + 7919 * (i * 37 % 100), f"id-{i}", "s") for i in range(100)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        run_etl(spark, write_text(tmp_path / "log.txt", lines(log)), database).discard()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = star_tables(spark, database)["user_listens"].groupBy("_metadata.file_path")
    spans = sorted(files.agg(F.min("listen_time"), F.max("listen_time")).toPandas().iloc[:, 1:].itertuples(index=False))
    assert len(spans) > 1
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_first_of_key_needs_no_sort_on_the_numbered_log(spark, tmp_path):
    raw = numbered(extract(spark, write_text(tmp_path / "log.txt", lines([*records(), *records()]))))
    assert raw.schema[ORDINAL].dataType.simpleString() == "bigint"
    for name in ("users", "artists", "time"):
        plan = valid_table(raw, name)._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan
    assert rows(valid_table(raw, "users").select("user_id", "user_name")) == USERS_EXPECTED


def test_quarantine_reasons_per_parent(spark):
    fact = spark.createDataFrame([(1, 1), (2, 9), (9, 9), (None, 1)], "a int, b int")
    ones = spark.createDataFrame([(1,), (2,)], "k int")
    kept, bad = quarantine_orphans(fact, {"a": ones.toDF("a"), "b": ones.toDF("b")})
    assert rows(kept) == [(1, 1), (None, 1)]
    assert rows(bad) == [(2, 9, ["b: no parent"]), (9, 9, ["a: no parent", "b: no parent"])]
