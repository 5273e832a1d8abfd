import tracemalloc
from zipfile import ZIP_DEFLATED, ZipFile

import pytest
from fixtures import LISTENS, lines, listen, records, rows, write_text, write_zip
from pyspark.sql import functions as F

from earshot import schemas as S
from earshot.errors import MissingDataException, UnsupportedFileFormatException
from earshot.operators.union import union_by_name
from earshot.operators.validation import check_required
from earshot.sources import zip_lines as Z
from earshot.sources.listens import ORDINAL, absent_paths, extract, flatten, malformed_lines, raw_lines
from earshot.sources.zip_lines import arrow_knows


def picked(df):
    return rows(df.select("listened_at", "recording_msid", "track_metadata.track_name"))


EXPECTED = sorted((str(t), i, s) for t, i, s in LISTENS)


@pytest.mark.parametrize("name", ["listens.txt", "listens.json"])
def test_text_formats(spark, tmp_path, name):
    assert picked(extract(spark, write_text(tmp_path / name, lines(records())))) == EXPECTED


def test_archive(spark, tmp_path):
    path = write_zip(tmp_path / "listens.zip", {"dataset.txt": lines(records())})
    assert picked(extract(spark, path)) == EXPECTED


def test_archive_has_one_partition_per_member(spark, tmp_path):
    second = listen(1, "x", "Song")
    del second["track_metadata"]["release_name"]
    path = write_zip(tmp_path / "two.zip", {"a.txt": lines(records()), "b.txt": lines([second]), "dir/": ""})
    assert raw_lines(spark, path).select("member").distinct().count() == 2
    df = extract(spark, path)
    assert df.count() == 4
    assert df.where("track_metadata.release_name IS NULL").count() == 1


def test_archive_keeps_line_order(spark, tmp_path):
    many = [listen(i, str(i), "s" * (i % 50)) for i in range(500)]
    path = write_zip(tmp_path / "many.zip", {"b.txt": lines(many[:250]), "a.txt": lines(many[250:])})
    ordered = extract(spark, path).orderBy(ORDINAL).select("recording_msid").collect()
    assert [r[0] for r in ordered] == [str(i) for i in range(500)]


def test_archive_line_ends_and_utf8(spark, tmp_path):
    text = lines([listen(1, "a", "Ünïcode   song")]) + "\r\n\r\n" + lines([listen(2, "b", "y")]) + "\n"
    zipped = extract(spark, write_zip(tmp_path / "crlf.zip", {"x.json": text}))
    plain = extract(spark, write_text(tmp_path / "crlf.json", text))
    assert picked(zipped) == picked(plain)
    assert len(picked(zipped)) == 2


def test_unsupported_format(spark):
    with pytest.raises(UnsupportedFileFormatException) as error:
        extract(spark, "tests/data/dataset.xml")
    assert "Unsupported file format, provide '.zip' or '.txt' file/path as input." in error.value.error


@pytest.mark.parametrize("schema", [S.RAW_LISTEN, None])
@pytest.mark.parametrize("kind", ["txt", "zip"])
def test_cut_off_record_fails_the_read(spark, tmp_path, schema, kind):
    cut = lines(records())[:135]
    path = tmp_path / f"corrupt.{kind}"
    path = write_zip(path, {"x.txt": cut}) if kind == "zip" else write_text(path, cut)
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        extract(spark, path, schema).collect()


@pytest.mark.parametrize("schema", [S.RAW_LISTEN, None])
def test_error_names_the_place_in_the_archive(spark, tmp_path, schema):
    good = lines(records())
    path = write_zip(tmp_path / "placed.zip", {"a.txt": good, "sub/b.txt": f"{good}\n\n{good[:135]}"})
    with pytest.raises(Exception, match=r"archive '.*placed\.zip', member 'sub/b\.txt', line 5"):
        extract(spark, path, schema).collect()


def test_places_of_malformed_lines_in_archives(spark, tmp_path):
    good = lines(records())
    path = write_zip(tmp_path / "bad.zip", {"a.txt": good, "b.txt": f"{{\n{good}\n\nno json"})
    found = malformed_lines(spark, path).collect()
    assert sorted((r.file.rsplit("/", 1)[1], r.member, r.line, r.value) for r in found) == [
        ("bad.zip", "b.txt", 1, "{"),
        ("bad.zip", "b.txt", 6, "no json"),
    ]


def test_places_of_malformed_lines_over_splits_and_files(spark, tmp_path):
    good = lines(records()).split("\n")[0]
    want = set()
    for name in ("a.json", "b.json"):
        rows_of = [("x" if i % 97 == 5 else "" if i % 10 == 0 else good) for i in range(400)]
        want |= {(name, i + 1) for i, row in enumerate(rows_of) if row == "x"}
        write_text(tmp_path / name, "\n".join(rows_of) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        found = malformed_lines(spark, f"{tmp_path}/*.json").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r.file.rsplit("/", 1)[1], r.line) for r in found) == sorted(want)
    assert malformed_lines(spark, write_text(tmp_path / "none.txt", "")).count() == 0


def test_archives_by_pattern(spark, tmp_path):
    for i in range(2):
        write_zip(tmp_path / f"part{i}.zip", {"x.txt": lines([listen(i, str(i), "s")])})
    assert sorted(r[0] for r in extract(spark, f"{tmp_path}/part*.zip").select("recording_msid").collect()) == ["0", "1"]


def test_archive_on_a_file_system_that_only_spark_knows(spark, tmp_path):
    write_zip(tmp_path / "far.zip", {"a.txt": lines(records()), "b.txt": lines(records())[:135]})
    hadoop = spark._jsc.hadoopConfiguration()
    hadoop.set("fs.viewfs.mounttable.logs.link./in", f"file://{tmp_path}")
    path = "viewfs://logs/in/far.zip"
    assert not arrow_knows(path)
    kept = extract(spark, path, corrupt_column="_corrupt")
    assert picked(kept.where("_corrupt IS NULL")) == EXPECTED
    [bad] = malformed_lines(spark, path).collect()
    assert (bad.file, bad.member, bad.line) == (path, "b.txt", 1)


def test_corrupt_column_keeps_the_line(spark, tmp_path):
    cut = lines(records())[:135]
    path = write_text(tmp_path / "corrupt.txt", lines(records()) + "\n" + cut)
    df = extract(spark, path, corrupt_column="_corrupt").cache()
    assert df.count() == 4
    assert [r[0] for r in df.where("_corrupt IS NOT NULL").select("_corrupt").collect()] == [cut]


@pytest.mark.parametrize("kind", ["txt", "zip"])
def test_inferred_and_flattened(spark, tmp_path, kind):
    text = lines(records())
    path = tmp_path / f"x.{kind}"
    path = write_zip(path, {"x.txt": text}) if kind == "zip" else write_text(path, text)
    flat = flatten(extract(spark, path, schema=None))
    names = set(flat.columns) - {ORDINAL}
    assert len(names) == 19  # null and empty fields included
    assert {"track_metadata.additional_info.isrc", "track_metadata.additional_info.tags"} <= names
    assert rows(flat.select("listened_at", "`track_metadata.track_name`")) == sorted((t, s) for t, _, s in LISTENS)


def test_missing_columns_by_schema(spark, tmp_path):
    short = [{"listened_at": 1, "recording_msid": "a", "user_name": "u"}, {"user_name": "u"}]
    path = write_text(tmp_path / "short.json", lines(short))
    missing = {
        "track_metadata.additional_info.artist_msid",
        "track_metadata.release_name",
        "track_metadata.artist_name",
        "track_metadata.track_name",
    }
    with pytest.raises(MissingDataException) as error:
        check_required(extract(spark, path, schema=None).schema, S.REQUIRED_PATHS)
    assert "Data has missing columns:" in error.value.error
    assert all(path in error.value.error for path in missing)
    declared = extract(spark, path)
    assert set(absent_paths(declared, raw_lines(spark, path), S.REQUIRED_PATHS)) == missing


def test_null_counts_as_present(spark, tmp_path):
    path = write_text(tmp_path / "null.json", lines([listen(1, "a", None), listen(2, "b", None)]))
    assert absent_paths(extract(spark, path), raw_lines(spark, path), S.REQUIRED_PATHS) == []


def test_late_value_counts_as_present(spark, tmp_path):
    short = {"listened_at": 1, "recording_msid": "a", "user_name": "u"}
    path = write_text(tmp_path / "late.json", lines([short] * 1500 + [listen(2, "b", "song")]))
    assert absent_paths(extract(spark, path), raw_lines(spark, path), S.REQUIRED_PATHS) == []


def test_union_by_name(spark):
    a, b = spark.createDataFrame([(1, "x")], "id int, a string"), spark.createDataFrame([(2.0, 2)], "b double, id int")
    assert rows(union_by_name([a, b]).select("id", "a", "b")) == [(1, "x", None), (2, None, 2.0)]


def test_scan_reads_only_the_needed_fields(spark, tmp_path):
    path = write_text(tmp_path / "listens.json", lines(records()))
    plan = extract(spark, path).select(F.col("user_name"), ORDINAL)._jdf.queryExecution().executedPlan()
    assert "ReadSchema: struct<user_name:string>" in plan.toString()


def test_a_member_of_short_lines_is_read_in_small_batches(tmp_path):
    lines = [f"line {i} é" if i % 7 else "" for i in range(500_000)]
    with ZipFile(tmp_path / "x.zip", "w", ZIP_DEFLATED) as archive:
        archive.writestr("m.txt", "\r\n".join(lines))
    count, most = 0, 0
    with ZipFile(tmp_path / "x.zip") as archive:
        tracemalloc.start()
        for batch in Z._lines(archive, "x.zip", 3, "m.txt"):
            assert batch.schema == Z.ARROW_SCHEMA and batch.column("value").to_pylist() == lines[count : count + batch.num_rows]
            assert batch.column("line")[0].as_py() == count and set(batch.column("member").to_pylist()) == {3}
            count += batch.num_rows
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
    assert count == len(lines)
    assert most < 40 << 20
