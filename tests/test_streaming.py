import base64
import json
import os
from datetime import datetime, timedelta, timezone

import pytest
from fixtures import rows
from pyspark.sql import functions as F

from earshot import schemas as S
from earshot.sources.lake import compact, read_lake, register_lake, write_partitioned
from earshot.streaming.enrich import enrich_events, rejected_events
from earshot.streaming.jobs import BUFFER_BYTES, read_events, replay, run_stream, spread_for_writing, stage_counts, with_slot


def event(i, name="a:b:c"):
    return {"event_uuid": f"id-{i}", "event_name": name, "created_at": 1712511721 + 1800 * i, "extra": i}


def put(folder, name, texts):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(t if isinstance(t, str) else json.dumps(t) for t in texts))


def drain(spark, source, root, **options):
    stream = read_events(spark, "text", str(source), maxFilesPerTrigger="1")
    queries = run_stream(stream, str(root), once=True, **options)
    for query in queries:
        query.awaitTermination()
    return sum(p["numInputRows"] for p in queries[0].recentProgress)


def lake(spark, root):
    return rows(read_lake(spark, f"{root}/data"))


def test_stream_equals_batch_and_restarts_where_it_stopped(spark, tmp_path):
    source, root = tmp_path / "in", tmp_path / "out"
    put(source, "1.json", [event(0), "{bad", event(1)])
    put(source, "2.json", [event(2), event(1)])
    assert drain(spark, source, root) == 5
    put(source, "3.json", [event(3), "[]"])
    assert drain(spark, source, root) == 2
    assert drain(spark, source, root) == 0

    batch = spark.read.text(str(source))
    assert lake(spark, root) == rows(enrich_events(batch))
    errors = spark.read.schema("value string, reason string").json(f"{root}/errors")
    assert rows(errors) == rows(rejected_events(batch))


def test_layout_compression_and_pruning(spark, tmp_path):
    source, root = tmp_path / "in", tmp_path / "out"
    put(source, "1.json", [event(i) for i in range(6)])
    drain(spark, source, root)
    files = [p.relative_to(root / "data") for p in (root / "data").rglob("*.parquet")]
    assert {str(f.parent) for f in files} == {f"year=2024/month=4/day=7/hour={h}" for h in (17, 18, 19, 20)}
    assert all(f.name.endswith(".snappy.parquet") for f in files)
    plan = read_lake(spark, f"{root}/data").where("hour = 18")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(hour" in plan


def test_duplicates_within_the_window(spark, tmp_path):
    source, root = tmp_path / "in", tmp_path / "out"
    put(source, "1.json", [event(0), event(0), event(1)])
    drain(spark, source, root, dedupe=True)
    put(source, "2.json", [event(1), event(2)])
    drain(spark, source, root, dedupe=True)
    assert [r[0] for r in lake(spark, root)] == ["id-0", "id-1", "id-2"]


def test_compaction_and_catalog(spark, tmp_path):
    source, root, table = tmp_path / "in", tmp_path / "out", "compacted_events"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    put(source, "1.json", [event(0), event(0), event(1)])
    drain(spark, source, root)
    target = str(tmp_path / "compacted")
    assert compact(spark, f"{root}/data", target, table) == 2
    assert compact(spark, f"{root}/data", target, table) == 0
    nameless = {k: v for k, v in event(2).items() if k != "event_uuid"}
    put(source, "1b.json", [nameless, nameless | {"event_name": "d"}])
    drain(spark, source, root)
    assert [compact(spark, f"{root}/data", target, table) for _ in range(3)] == [2, 0, 0]
    spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    put(source, "2.json", [event(1), event(2)])
    drain(spark, source, root)
    assert compact(spark, f"{root}/data", target, table) == 1
    assert sorted(r[0] or "" for r in rows(spark.table(table))) == ["", "", "id-0", "id-1", "id-2"]
    assert spark.read.parquet(str(tmp_path / "compacted-ids" / "records")).agg({"n": "sum"}).first()[0] == 5
    assert len(spark.sql(f"SHOW PARTITIONS {table}").collect()) == 2
    assert spark.table(table).schema.names == [*S.LAKE_EVENT.names, *S.PARTITION_KEYS]
    # one file per hour and compaction: 17 and 18 h first, then 18 h twice
    assert len(list((tmp_path / "compacted").rglob("*.snappy.parquet"))) == 4
    spark.sql(f"DROP TABLE {table}")


def test_existing_lake_gets_a_table(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS lake_events")
    path = str(tmp_path / "lake")
    texts = spark.createDataFrame([(json.dumps(event(i)),) for i in range(4)], "value string")
    write_partitioned(enrich_events(texts), path)
    register_lake(spark, "lake_events", path)
    assert rows(spark.table("lake_events")) == rows(enrich_events(texts))
    assert len(spark.sql("SHOW PARTITIONS lake_events").collect()) == 3
    assert "lake_events" in [t.name for t in spark.catalog.listTables()]
    spark.sql("DROP TABLE lake_events")


@pytest.mark.parametrize("tasks", [1, 4, 9])
def test_writers_of_an_hour_grow_with_its_volume(spark, tasks):
    one_hour = spark.range(0, 100 * tasks, 1, tasks).selectExpr("2024 as year", "4 as month", "7 as day", "17 as hour")
    slotted = spread_for_writing(with_slot(one_hour))
    assert slotted.select("_slot").distinct().count() == tasks
    assert slotted.selectExpr("_slot", "spark_partition_id() as p").distinct().count() == tasks
    assert (slotted.selectExpr("spark_partition_id() as p").distinct().count() > 1) == (tasks > 1)


def test_late_first_events_and_events_without_id_stay(spark, tmp_path):
    source, root = tmp_path / "in", tmp_path / "out"
    old = event(9) | {"created_at": 1712511721 - 8 * 86_400}
    nameless = {k: v for k, v in event(3).items() if k != "event_uuid"}
    for i, texts in enumerate([[event(0), event(1)], [event(400)], [old, event(0)], [nameless, nameless], [nameless, event(2)]]):
        put(source, f"{i}.json", texts)
        drain(spark, source, root, dedupe=True)
    found = [r[0] for r in lake(spark, root)]
    assert sorted(x for x in found if x) == ["id-0", "id-1", "id-2", "id-400", "id-9"]
    assert found.count(None) == 3


def test_envelopes_and_their_errors(spark, tmp_path):
    source, root = tmp_path / "in", tmp_path / "out"
    texts = [json.dumps(event(0)), "{bad", json.dumps(event(1))]
    records = [{"recordId": f"r{i}", "data": base64.b64encode(t.encode()).decode()} for i, t in enumerate(texts)]
    put(source, "1.json", [*records, {"recordId": "r9", "data": "*"}])
    stream = read_events(spark, "json", str(source), "recordId string, data string", buffer_bytes=BUFFER_BYTES)
    for query in run_stream(stream, str(root), once=True, envelopes=True):
        query.awaitTermination()
    assert [r[0] for r in lake(spark, root)] == ["id-0", "id-1"]
    errors = spark.read.schema("recordId string, reason string").json(f"{root}/errors")
    assert rows(errors) == [("r1", "not a JSON object"), ("r9", "not base64 of UTF-8 text")]


def test_a_start_time_needs_a_log(spark, tmp_path):
    with pytest.raises(ValueError, match="start time"):
        read_events(spark, "text", str(tmp_path), start=datetime(2024, 1, 1))


def test_own_processor(spark, tmp_path):
    source, root = tmp_path / "in", tmp_path / "out"
    put(source, "1.json", [event(0), event(1, "x:y")])
    only_named = lambda df: enrich_events(df).where("event_subtype <> ''")
    unnamed = lambda df: enrich_events(df).where("event_subtype = ''").selectExpr("event_uuid", "'no subtype' AS reason")
    drain(spark, source, root, processor=only_named, rejects=unnamed)
    assert [r[0] for r in lake(spark, root)] == ["id-0"]
    assert rows(spark.read.schema("event_uuid string, reason string").json(f"{root}/errors")) == [("id-1", "no subtype")]


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        read_events(spark, "kafka", subscribe="events")


def test_events_without_id_leave_no_state(spark, tmp_path):
    source, root = tmp_path / "in", tmp_path / "out"
    nameless = {k: v for k, v in event(3).items() if k != "event_uuid"}
    put(source, "1.json", [event(0), event(0), *[nameless] * 40])
    for query in run_stream(read_events(spark, "text", str(source)), str(root), once=True, dedupe=True):
        query.awaitTermination()
        state = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
        assert not state or max(state) == 1
    assert [r[0] for r in lake(spark, root)].count(None) == 40


@pytest.fixture
def hours(spark, tmp_path):
    """A table filled by three runs of compaction, an hour each, and what a further run reads of it."""
    spark.sql("DROP TABLE IF EXISTS filtered_events")
    source, target = str(tmp_path / "lake"), str(tmp_path / "table")

    def run(events):
        texts = spark.createDataFrame([(json.dumps(e),) for e in events], "value string")
        write_partitioned(enrich_events(texts), source, "overwrite")
        return compact(spark, source, target, "filtered_events")

    yield run, target
    spark.sql("DROP TABLE filtered_events")


def test_compaction_reads_the_ids_of_touched_hours_only(spark, hours, monkeypatch):
    from earshot.sources import lake as L

    run, target = hours
    read = []
    ids = L.stored_ids
    monkeypatch.setattr(L, "stored_ids", lambda spark, table, hours: read.append(sorted(h % 100 for h in hours)) or ids(spark, table, hours))
    at = lambda i, hour: event(i) | {"created_at": 1712511721 + 3600 * hour}
    assert run([at(i, 0) for i in range(50)]) == 50
    assert run([at(100 + i, 1) for i in range(50)]) == 50
    assert run([at(200 + i, 2) for i in range(50)] + [at(7, 2), at(107, 5)]) == 50
    assert run([at(300, 3), at(120, 3)]) == 1
    assert read == [[], [], [17, 18], [18]]
    plan = L.stored_ids(spark, "filtered_events", [2024040718])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2024040718" in plan.split("PartitionFilters")[1]
    assert spark.table("filtered_events").count() == 151


def test_rows_that_the_filters_do_not_know_are_read(spark, hours):
    run, target = hours
    assert run([event(0), event(1)]) == 2
    other = spark.table("filtered_events").where("event_uuid = 'id-0'").withColumn("event_uuid", F.lit("id-77"))
    other.select(*spark.table("filtered_events").columns).write.insertInto("filtered_events")
    assert run([event(77), event(0), event(5)]) == 1
    assert run([event(77) | {"created_at": 1712511721 + 90_000}]) == 0


def test_a_cut_run_leaves_the_filters_safe(spark, hours, monkeypatch):
    from earshot.sources import lake as L

    run, target = hours
    assert run([event(0)]) == 1
    append = L.append_by_name

    def cut(*args):
        append(*args)
        raise OSError("cut")

    monkeypatch.setattr(L, "append_by_name", cut)
    with pytest.raises(OSError):
        run([event(0), event(1)])
    monkeypatch.setattr(L, "append_by_name", append)
    assert run([event(0), event(1), event(2)]) == 1
    assert sorted(r[0] for r in rows(spark.table("filtered_events"))) == ["id-0", "id-1", "id-2"]


def test_only_the_partitions_of_a_run_are_added(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS stepwise_events")
    path = str(tmp_path / "lake")
    enriched = [enrich_events(spark.createDataFrame([(json.dumps(event(i)),) for i in n], "value string")) for n in (range(4), range(2, 8))]
    for df, added in zip(enriched, (3, 2), strict=True):
        write_partitioned(df, path)
        assert register_lake(spark, "stepwise_events", path, df) == added
    assert register_lake(spark, "stepwise_events", path, enriched[0]) == 0
    assert spark.table("stepwise_events").count() == 10
    spark.sql("DROP TABLE stepwise_events")


@pytest.mark.parametrize("dedupe", [False, True])
def test_counts_of_the_stages_add_up(spark, tmp_path, dedupe):
    source, root = tmp_path / "in", tmp_path / "out"
    nameless = {k: v for k, v in event(3).items() if k != "event_uuid"}
    put(source, "1.json", [event(0), "{bad", event(1), "[]", event(2) | {"created_at": "soon"}])
    put(source, "2.json", [event(0), "{bad", nameless, nameless, event(5) | {"event_name": 7}])
    stream = read_events(spark, "text", str(source), maxFilesPerTrigger="1")
    queries = run_stream(stream, str(root), once=True, dedupe=dedupe)
    for query in queries:
        query.awaitTermination()
    counts = stage_counts(queries)
    rejected = {"not a JSON object": 3, "created_at is not a time": 1, "event_name is not a text": 1}
    assert counts == {"written": 4 if dedupe else 5, **rejected}
    assert sum(counts.values()) == 10 - dedupe


def test_reasons_of_ones_own_are_counted_as_others(spark, tmp_path):
    put(tmp_path / "in", "1.json", [event(0), event(1)])
    unnamed = lambda df: enrich_events(df).selectExpr("event_uuid", "'odd' AS reason")
    queries = run_stream(read_events(spark, "text", str(tmp_path / "in")), str(tmp_path / "out"), once=True, rejects=unnamed)
    for query in queries:
        query.awaitTermination()
    assert stage_counts(queries) == {"written": 2, "another reason": 2}


def test_a_window_can_be_replayed(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS replayed_events")
    source, root, target = tmp_path / "in", tmp_path / "out", str(tmp_path / "table")
    noon = datetime(2024, 5, 1, 12, tzinfo=timezone.utc)
    for i in range(4):
        put(source, f"{i}.json", [event(2 * i), event(2 * i + 1)])
        at = (noon + timedelta(hours=i)).timestamp()
        os.utime(source / f"{i}.json", (at, at))
    put(tmp_path / "first", "0.json", [event(2)])
    drain(spark, tmp_path / "first", root)
    assert compact(spark, f"{root}/data", target, "replayed_events") == 1
    start, end = datetime(2024, 5, 1, 13), datetime(2024, 5, 1, 15)
    assert [replay(spark, str(source), target, "replayed_events", start, end) for _ in range(2)] == [3, 0]
    assert sorted(r[0] for r in rows(spark.table("replayed_events"))) == ["id-2", "id-3", "id-4", "id-5"]
    assert replay(spark, str(source), target, "replayed_events", datetime(2024, 5, 1), end) == 2
    spark.sql("DROP TABLE replayed_events")
