"""CSV files read by ranges against Spark's own reader, and zip archives."""

import bz2
import csv
import gzip
import io
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from newsloom.sources import files, ranges


@pytest.mark.parametrize(
    "line,inside,want",
    [
        ("a,b", False, False), ('a,"b', False, True), ('a,"b""', False, True), ('a,"b"""', False, False), ('a,b"c', False, False),
        ('"a,b",c', False, False), ('"a","b', False, True), ("x", True, True), ('x"', True, False), ('x"",y', True, True),
        ('x",y,"z', True, True), ('x",y,"z"', True, False), ('""', False, False), ('"', False, True), ("", True, True), ("", False, False),
        ('a"b,"c', False, True), ('x""', True, True), ('x"""', True, False),
    ],
)
def test_quotes(line, inside, want):
    assert ranges.ends_inside(line, inside) is want


def test_fields_of_odd_records():
    assert ranges.fields('a,"b, ""c""\nd",') == ["a", 'b, "c"\nd', ""]
    assert ranges.fields('a\rb,"c"') == ["a\rb", "c"]
    assert ranges.fields("x" * 200_000 + ",y")[1] == "y"


def messy(seed, n):
    """Values with commas, quotes, blanks and line breaks of both kinds, short and long."""
    rng = random.Random(seed)
    pieces = ["a", "bc ", " d", ",", '"', "\n", "\r\n", '""', "é", ",\n,", '"\n"', "\n\n"]

    def value():
        size = rng.choice([0, 1, 3, 8, 60])
        return "".join(rng.choice(pieces) for _ in range(size))

    return [[str(i), value(), value() if rng.random() < 0.99 else "long\n" * 3000, "2024-01-02 03:04:05"] for i in range(n)]


def written(path, rows, end="\n", opened=open):
    with opened(path, "wt", newline="", encoding="utf-8") as f:
        writer = csv.writer(f, lineterminator=end)
        writer.writerow(["id", "x", "y", "datetime"])
        writer.writerows(rows)
    return path


@pytest.fixture
def small_ranges(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("seed,end", [(1, "\n"), (2, "\n"), (3, "\r\n")])
def test_one_file_by_many_tasks_equals_sparks_reader(spark, tmp_path, small_ranges, seed, end):
    rows = messy(seed, 400)
    path = str(written(tmp_path / "big.csv", rows, end))
    columns = ["id", "x", "y", "datetime"]
    whole = files.read_csv(spark, path, columns, by_ranges=False)
    parts = files.read_csv(spark, path, columns, by_ranges=True)
    assert whole.rdd.getNumPartitions() == 1 and ranges.CsvFiles(spark, [path]).records.rdd.getNumPartitions() > 10
    want = sorted(map(tuple, whole.collect()))
    assert sorted(map(tuple, parts.collect())) == want and len(want) == 400
    kept = (lambda v: v.replace("\r\n", "\n") or None) if end == "\r\n" else (lambda v: v or None)
    assert sorted(map(str, (r[:3] for r in want))) == sorted(str((a, kept(b), kept(c))) for a, b, c, _ in rows)


def test_header_longer_than_a_range_blank_lines_and_no_end(spark, tmp_path, small_ranges):
    path = tmp_path / "odd.csv"
    path.write_text('\n\n"' + "long\n" * 2000 + '",b\n\n1,2\n3,"4\n\n5"')
    found = ranges.CsvFiles(spark, [str(path)])
    assert [ranges.fields(r.header)[1] for r in found.headers.collect()] == ["b"]
    assert sorted(r.record for r in found.records.collect()) == ["1,2", '3,"4\n\n5"']
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "only.csv").write_text("a,b\n")
    none = ranges.CsvFiles(spark, [str(tmp_path / "empty.csv"), str(tmp_path / "only.csv")])
    assert none.records.isEmpty() and [r.header for r in none.headers.collect()] == ["a,b"]


def test_sizes_decide(spark, tmp_path, monkeypatch):
    path = str(written(tmp_path / "a.csv", messy(5, 20)))
    columns = ["id", "x", "y", "datetime"]
    want = sorted(map(tuple, files.read_csv(spark, path, columns).collect()))
    used = []
    monkeypatch.setattr(files, "CsvFiles", lambda *a, **k: used.append(a) or ranges.CsvFiles(*a, **k))
    assert files.read_csv(spark, path, columns).count() == 20 and not used
    monkeypatch.setattr(files, "LARGE_FILE", 100)
    assert sorted(map(tuple, files.read_csv(spark, path, columns).collect())) == want and used


def zipped(path, members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in members.items():
            z.writestr(name, text)


def test_folder_of_all_kinds(spark, tmp_path, small_ranges):
    """Plain, gzip, bzip2 and zip with different columns; broken files are skipped and told."""
    rows = messy(7, 150)
    text = io.StringIO(newline="")
    csv.writer(text, lineterminator="\n").writerows([["id", "x", "y", "datetime"], *rows])
    (tmp_path / "a.csv").write_text(text.getvalue())
    with gzip.open(tmp_path / "b.csv.gz", "wt") as f:
        f.write("y,id,z\nb,gz,1\n")
    with bz2.open(tmp_path / "c.csv.bz2", "wt") as f:
        f.write('id,x\nbz,"two, and\nmore"\n')
    zipped(tmp_path / "d.csv.zip", {"inside.csv": text.getvalue()})
    zipped(tmp_path / "two.csv.zip", {"a.csv": "id\n1\n", "b.csv": "id\n2\n"})
    zipped(tmp_path / "none.csv.zip", {"a.csv": ""})
    zipped(tmp_path / "old_e.csv.zip", {"a.csv": "id\nold\n"})
    (tmp_path / "broken.csv.zip").write_bytes(b"no archive")
    (tmp_path / "broken.csv.gz").write_bytes(b"no gzip at all")
    (tmp_path / "other.zip").write_bytes(b"not by its name")
    got = files.folder_scan(spark, str(tmp_path), ["x", "id", "nowhere"], exclude="old")
    assert got.columns == ["x", "id"]
    want = [(x or None, i) for i, x, _, _ in rows] * 2 + [(None, "gz"), ("two, and\nmore", "bz")]
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))
    every = files.folder_scan(spark, str(tmp_path), exclude="old")
    assert sorted(every.columns) == ["datetime", "id", "x", "y", "z"] and every.count() == len(want)
    told = {r.file: (r.compression, r.loaded, r.error) for r in files.folder_files(spark, str(tmp_path), "old").collect()}
    assert {f for f, (_, loaded, _) in told.items() if loaded} == {"a.csv", "b.csv.gz", "c.csv.bz2", "d.csv.zip"}
    assert "2 members" in told["two.csv.zip"][2] and "BadZipFile" in told["broken.csv.zip"][2] and told["none.csv.zip"][2] and len(told) == 8
    summary = {r.compression: tuple(r)[1:] for r in files.folder_summary(spark, str(tmp_path), "old").collect()}
    assert summary == {"uncompressed": (1, 0), ".gz": (1, 1), ".bz2": (1, 0), ".zip": (1, 3)}


def test_archive_that_breaks_off(spark, tmp_path, monkeypatch):
    """Rows before the break come, then the error; archives beyond the bound are told, not opened."""
    lines = "".join(f"{i},{random.Random(i).random()}\n" for i in range(20_000))
    zipped(tmp_path / "a.csv.zip", {"a.csv": "id,x\n" + lines})
    data = bytearray((tmp_path / "a.csv.zip").read_bytes())
    data[len(data) * 3 // 4] ^= 0xFF
    (tmp_path / "a.csv.zip").write_bytes(data)
    got = ranges.zip_records(spark, str(tmp_path), ["x"])
    assert got.where("error is not null").count() == 1 and got.where("values is not null").count() > 5000
    monkeypatch.setattr(ranges, "MAX_ARCHIVE", 1000)
    assert "more than 1000 bytes" in ranges.zip_headers(spark, str(tmp_path)).first().error
    assert ranges.zip_records(spark, str(tmp_path), ["x"]).isEmpty()
