import json
import time

from earshot.streaming.buffer import buffered
from earshot.streaming.jobs import read_events

def put(folder, name, texts):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(texts))


def delivered(spark, out):
    if not list(out.glob("*.json")):
        return []
    rows = spark.read.schema("buffer int, delivery bigint, delivered_by string, value string").json(str(out)).collect()
    return sorted((r.delivery, r.delivered_by, r.value) for r in rows)


def start(spark, source, root, seconds, max_bytes=100, once=False):
    events = read_events(spark, "text", str(source))
    trigger = {"once": True} if once else {"processingTime": "500 milliseconds"}
    stream = buffered(events, buffers=1, max_bytes=max_bytes, max_seconds=seconds)
    return (
        stream.writeStream.format("json").option("checkpointLocation", str(root / "state")).trigger(**trigger).start(str(root / "out"))
    )


def wait(spark, root, n, limit=60):
    end = time.time() + limit
    while len(found := delivered(spark, root / "out")) < n and time.time() < end:
        time.sleep(0.5)
    return found


def test_a_burst_goes_by_size_and_a_restart_keeps_the_rest(spark, tmp_path):
    source, root = tmp_path / "in", tmp_path / "run"
    put(source, "1", [f"{i:010}" for i in range(25)])
    start(spark, source, root, 3600, once=True).awaitTermination()
    found = delivered(spark, root / "out")
    assert len(found) == 20 and {d for d, _, _ in found} == {0, 1} and {by for _, by, _ in found} == {"size"}
    put(source, "2", [f"{i:010}" for i in range(25, 32)])
    start(spark, source, root, 3600, once=True).awaitTermination()
    found = delivered(spark, root / "out")
    assert len(found) == 30 and [sum(d == k for d, _, _ in found) for k in range(3)] == [10, 10, 10]
    assert len({v for _, _, v in found}) == 30


def test_a_trickle_goes_by_time_across_a_restart(spark, tmp_path):
    source, root = tmp_path / "in", tmp_path / "run"
    put(source, "1", ["a", "b"])
    start(spark, source, root, 4, once=True).awaitTermination()
    assert delivered(spark, root / "out") == []
    query = start(spark, source, root, 4)
    try:
        assert wait(spark, root, 2) == [(0, "time", "a"), (0, "time", "b")]
        put(source, "2", ["c"])
        assert wait(spark, root, 3)[2:] == [(1, "time", "c")]
    finally:
        query.stop()


def test_large_events_and_limits_that_are_met_exactly(spark, tmp_path):
    source, root = tmp_path / "in", tmp_path / "run"
    put(source, "1", ["x" * 250, "é" * 50, "y" * 60, "z" * 60])
    start(spark, source, root, 3600, once=True).awaitTermination()
    found = delivered(spark, root / "out")
    assert [(d, v[0]) for d, _, v in found] == [(0, "x"), (1, "é"), (2, "y")]


def test_keys_have_buffers_of_their_own(spark, tmp_path):
    source, root = tmp_path / "in", tmp_path / "run"
    put(source, "1", [json.dumps({"k": i % 2, "v": f"{i:06}"}) for i in range(40)])
    events = read_events(spark, "text", str(source)).selectExpr("int(get_json_object(value, '$.k')) AS k", "value")
    stream = buffered(events, ["k"], buffers=2, max_bytes=100, max_seconds=3600)
    query = (
        stream.writeStream.format("json").option("checkpointLocation", str(root / "state")).trigger(once=True).start(str(root / "out"))
    )
    query.awaitTermination()
    rows = spark.read.schema("k int, buffer int, delivery bigint, value string").json(str(root / "out")).collect()
    sizes = {}
    for r in rows:
        sizes[r.k, r.buffer, r.delivery] = sizes.get((r.k, r.buffer, r.delivery), 0) + len(r.value)
    assert {(k, b) for k, b, _ in sizes} <= {(k, b) for k in (0, 1) for b in (0, 1)} and len(sizes) >= 4
    assert all(60 <= size <= 100 for size in sizes.values())
    assert all(json.loads(r.value)["k"] == r.k for r in rows)
