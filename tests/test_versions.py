import datetime as dt
import json

import pytest
from fixtures import rows
from test_streaming import event, put

from earshot import schemas as S
from earshot.operators.sizing import listed
from earshot.plans import publish as P
from earshot.plans.publish import publish, published_star
from earshot.sources.lake import read_lake, write_partitioned
from earshot.sources.packing import lake_files, pack, packed_lake, planned
from earshot.sources.versions import Versions
from earshot.streaming.enrich import enrich_events
from earshot.streaming.jobs import read_events, run_stream

SEC = 1700000000


def star(spark, ids):
    """Frames of a star with a listen for each id."""
    at = [dt.datetime.fromtimestamp(SEC + i, dt.timezone.utc).replace(tzinfo=None) for i in ids]
    data = {
        "users": [(f"u{i % 3}", f"name {i % 3}") for i in ids],
        "artists": [(f"a{i}", f"artist {i}") for i in ids],
        "time": [(SEC + i, t, t.date(), t.year, t.month, t.day, "day", t.hour) for i, t in zip(ids, at, strict=True)],
        "user_listens": [(f"l{i}", f"u{i % 3}", SEC + i, f"a{i}", "song", "album") for i in ids],
    }
    return {name: spark.createDataFrame(sorted(set(found)), S.STAR_TABLES[name]) for name, found in data.items()}


def contents(spark, root, version=None):
    return {name: rows(df) for name, df in published_star(spark, root, version).items()}


def test_published_loads(spark, tmp_path):
    root = str(tmp_path / "star")
    assert all(df.isEmpty() for df in published_star(spark, root).values())
    assert publish(spark, star(spark, range(4)), root).offered == {"users": 3, "artists": 4, "time": 4, "user_listens": 4}
    first = contents(spark, root)
    assert first == {name: rows(df) for name, df in star(spark, range(4)).items()}
    publish(spark, star(spark, range(4)), root)
    assert Versions(spark, root).newest() == 1
    publish(spark, star(spark, range(2, 9)), root)
    assert contents(spark, root) == {name: rows(df) for name, df in star(spark, range(9)).items()}
    assert contents(spark, root, 1) == first


@pytest.mark.parametrize("step", [0, 1, 3, 4])
def test_a_cut_load_changes_nothing_for_readers(spark, tmp_path, monkeypatch, step):
    """The load ends at one of the tables, or at the switch itself."""
    root = str(tmp_path / "star")
    publish(spark, star(spark, range(3)), root)
    before, calls = contents(spark, root), []
    with monkeypatch.context() as patch:
        fresh = P.rows_to_add

        def cut(*args):
            calls.append(args[0])
            if len(calls) > step:
                raise OSError("cut")
            return fresh(*args)

        if step < 4:
            patch.setattr(P, "rows_to_add", cut)
        else:
            patch.setattr(Versions, "publish", cut)
            calls.extend("switch" for _ in range(4))
        with pytest.raises(OSError):
            publish(spark, star(spark, range(6)), root)
    assert contents(spark, root) == before and Versions(spark, root).newest() == 1
    publish(spark, star(spark, range(6)), root)
    assert contents(spark, root) == {name: rows(df) for name, df in star(spark, range(6)).items()}
    left = Versions(spark, root).clean()
    assert left >= (0 if step == 0 else 1) and contents(spark, root) == {name: rows(df) for name, df in star(spark, range(6)).items()}


def test_a_version_without_success_is_not_read(spark, tmp_path):
    versions = Versions(spark, str(tmp_path / "v"))
    folder, path = versions.new_folder("users")
    spark.createDataFrame([("u", "n")], S.USERS).write.parquet(path)
    assert versions.publish({"users": [folder]}) == 1
    spark.createDataFrame([("users", "users/none")], "name string, folder string").write.parquet(f"{versions.root}/versions/2")
    (tmp_path / "v" / "versions" / "2" / "_SUCCESS").unlink()
    assert versions.newest() == 1
    assert versions.publish({"users": [folder]}, replace=True) == 2 and versions.folders() == {"users": [folder]}


def test_orphans_and_buckets(spark, tmp_path):
    frames = star(spark, range(3))
    frames["artists"] = frames["artists"].where("artist_id <> 'a1'")
    result = publish(spark, frames, str(tmp_path / "star"), orphans="quarantine")
    assert result.orphans.count() == 1 and published_star(spark, str(tmp_path / "star"))["user_listens"].count() == 2
    with pytest.raises(ValueError, match="buckets"):
        publish(spark, frames, str(tmp_path / "star"), buckets=4)


def stream(spark, source, root):
    events = read_events(spark, "text", str(source), maxFilesPerTrigger="1")
    for query in run_stream(events, str(root), once=True):
        query.awaitTermination()


def files_by_hour(target):
    found = {}
    for path in (target / "data" / "events").rglob("*.parquet"):
        hour = next(p for p in path.parts if p.startswith("hour="))
        found[hour] = found.get(hour, 0) + 1
    return found


def test_small_files_of_an_hour_become_few(spark, tmp_path):
    source, root, target = tmp_path / "in", tmp_path / "out", tmp_path / "packed"
    for i in range(6):
        put(source, f"{i}.json", [event(100 * i + k) | {"created_at": 1712511721 + 3600 * (k % 2)} for k in range(6)])
    stream(spark, source, root)
    lake = f"{root}/data"
    assert lake_files(spark, lake).count() == 12
    assert pack(spark, lake, str(target)) == 0  # no bin is full, no hour closed
    closed = dt.datetime(2024, 4, 7, 18)
    assert pack(spark, lake, str(target), closed_before=closed) == 6
    assert files_by_hour(target) == {"hour=17": 1}
    assert pack(spark, lake, str(target), closed_before=closed) == 0 and Versions(spark, str(target)).newest() == 1
    assert rows(packed_lake(spark, str(target), lake)) == rows(read_lake(spark, lake))
    put(source, "7.json", [event(900) | {"created_at": 1712511721}, event(901) | {"created_at": 1712511721 + 3600}])
    stream(spark, source, root)
    assert pack(spark, lake, str(target), closed_before=dt.datetime(2024, 4, 8)) == 8
    assert rows(packed_lake(spark, str(target))) == rows(read_lake(spark, lake))
    assert files_by_hour(target) == {"hour=17": 2, "hour=18": 1}


def test_bins_follow_the_volume(spark, tmp_path):
    sizes = [50, 40, 30, 30, 20, 10, 10, 5]
    files = [(2024, 1, 1, h, f"f{i}", f"p{h}-{i}", s) for h in (1, 2) for i, s in enumerate(sizes)]
    files = spark.createDataFrame(files, "year int, month int, day int, hour int, file string, path string, length bigint")
    whole = planned(files, 60, dt.datetime(2024, 1, 1, 2)).collect()
    bins = {}
    for r in whole:
        bins.setdefault((r.hour, r.bin), []).append(r.length)
    assert sorted(x for (h, _), v in bins.items() if h == 1 for x in v) == sorted(sizes)
    assert all(sum(v) < 60 + 50 for v in bins.values()) and sum(h == 1 for h, _ in bins) <= -(-sum(sizes) // 60)
    assert all(sum(v) >= 60 for (h, _), v in bins.items() if h == 2)


def test_a_cut_packing_is_done_again(spark, tmp_path, monkeypatch):
    texts = spark.createDataFrame([(json.dumps(event(i)),) for i in range(9)], "value string")
    lake, target = str(tmp_path / "lake"), str(tmp_path / "packed")
    write_partitioned(enrich_events(texts), lake)
    with monkeypatch.context() as patch:
        patch.setattr(Versions, "publish", lambda *args: (_ for _ in ()).throw(OSError("cut")))
        with pytest.raises(OSError):
            pack(spark, lake, target, closed_before=dt.datetime(2025, 1, 1))
    assert packed_lake(spark, target).isEmpty() and listed(spark, f"{target}/data/events/*")
    assert pack(spark, lake, target, closed_before=dt.datetime(2025, 1, 1)) > 0
    assert Versions(spark, target).clean() == 2
    assert rows(packed_lake(spark, target)) == rows(read_lake(spark, lake))
