"""Committed versions, buckets, and writers that meet."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from newsloom.operators.merge import SEQ, append_distinct, upsert
from newsloom.session import stored
from newsloom.sources import tables

T0 = dt.datetime(2024, 1, 1)
KIND = f"url string, title string, search_terms string, datetime timestamp_ntz, {SEQ} long"


def batch(spark, keys, title, term="x"):
    rows = [(f"u{k}" if k is not None else None, f"{title} {k}", f'["{term}"]', T0 + dt.timedelta(days=i), i) for i, k in enumerate(keys)]
    return spark.createDataFrame(rows, KIND)


def content(df):
    return sorted((r.url, r.title, tuple(r.search_terms), r.datetime) for r in df.collect())


def test_a_batch_of_one_key_reads_and_writes_one_bucket(spark, tmp_path):
    path = str(tmp_path / "main")
    first = batch(spark, range(200), "old")
    assert tables.upsert_main(first, path, bucket_rows=10) == tables.Commit(1, 0, 32)
    before = tables.version(spark, path)
    assert before.buckets == 32 and sum(before.rows.values()) == 200
    one = batch(spark, [7], "new", "y")
    assert tables.upsert_main(one, path, bucket_rows=10) == tables.Commit(2, 1, 1)
    after = tables.version(spark, path)
    changed = [b for b in after.folders if after.folders[b] != before.folders.get(b)]
    assert len(changed) == 1 and set(before.folders) == set(after.folders)
    files = tables.rows_of(spark, path, after, changed).inputFiles()
    assert len(files) == 1 and len(tables.read_snapshot(spark, path).inputFiles()) == len(after.folders)
    want = upsert(one, upsert(first, None).drop(SEQ), main_is_unique=True)
    assert content(tables.read_snapshot(spark, path)) == content(want)
    # The version before is still there.
    assert content(tables.read_snapshot(spark, path, 1)) == content(upsert(first, None))


def test_buckets_grow_with_the_table(spark, tmp_path):
    path, want = str(tmp_path / "main"), None
    for i, keys in enumerate((range(5), range(3, 60), [None, 1, 1, 2], range(50, 300), [7])):
        rows = batch(spark, keys, f"t{i}", f"term{i}")
        tables.upsert_main(rows, path, bucket_rows=8)
        want = upsert(rows, want, main_is_unique=True).drop(SEQ) if want is not None else upsert(rows, None).drop(SEQ)
        want = stored(want, "want")
        assert content(tables.read_snapshot(spark, path)) == content(want)
    now = tables.version(spark, path)
    assert now.number == 5 and now.buckets >= 16 and sum(now.rows.values()) == 300
    assert max(now.rows.values()) < 60


def test_a_whole_table_gets_buckets(spark, tmp_path):
    path = str(tmp_path / "main")
    old = upsert(batch(spark, range(50), "old"), None).drop(SEQ)
    tables.write_snapshot(old, path)
    tables.upsert_main(batch(spark, [3], "new"), path, bucket_rows=10)
    got = {r.url: r.title for r in tables.read_snapshot(spark, path).collect()}
    assert len(got) == 50 and got["u3"] == "new 3" and got["u4"] == "old 4"
    assert tables.version(spark, path).buckets == 8


def test_appends_write_only_new_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "main")
    kind = "a int, x double, tags array<string>"
    rows = [(i % 40, float(i % 40), [str(i % 40)]) for i in range(60)] + [(None, None, None), (None, None, None), (1, -0.0, []), (1, 0.0, [])]
    df = spark.createDataFrame(rows, kind)
    assert tables.append_main(df, path, ("a",), bucket_rows=4).number == 1
    n = df.distinct().count()
    assert tables.read_snapshot(spark, path).count() == n == 42
    # Nothing new: no version. One new row: one bucket is read, and one row is written beside the others.
    assert tables.append_main(df, path, ("a",), bucket_rows=4).buckets_written == 0 and tables.versions(spark, path) == [1]
    done = tables.append_main(spark.createDataFrame([(99, 1.5, ["n"])], kind), path, ("a",), bucket_rows=4)
    assert (done.number, done.buckets_read, done.buckets_written) == (2, 1, 1)
    monkeypatch.setattr(tables, "MAX_FOLDERS", 2)
    want = append_distinct(spark.createDataFrame([(99, 1.5, ["n"])], kind), df)
    for i in range(4):
        more = spark.createDataFrame([(200 + j, float(i), None) for j in range(30)], kind)
        tables.append_main(more, path, ("a",), bucket_rows=4)
        want = append_distinct(more, want)
        now = tables.version(spark, path)
        assert max(map(len, now.folders.values())) <= 3
        assert sum(now.rows.values()) == want.count()
    assert sorted(map(str, tables.read_snapshot(spark, path).collect())) == sorted(map(str, want.collect()))


def test_a_second_writer_finds_the_number_taken(spark, tmp_path):
    path = str(tmp_path / "main")
    one = spark.createDataFrame([(T0, 1)], "datetime timestamp_ntz, v int")
    tables.write_snapshot(one, path)
    seen = []

    def add(old):
        if not seen:  # another writer is faster, once
            tables.update_snapshot(spark, path, lambda o: o.unionByName(one.withColumn("v", F.lit(10))))
        seen.append(old.count())
        return old.unionByName(one.withColumn("v", F.lit(100)))

    assert tables.update_snapshot(spark, path, add) == 3
    assert seen == [1, 2]  # it started again from what the other had written
    assert sorted(r.v for r in tables.read_snapshot(spark, path).collect()) == [1, 10, 100]
    taken = tables.version(spark, path, 2)
    assert not tables.commit(spark, path, taken)
    assert tables.versions(spark, path) == [1, 2, 3]
    assert not [p for p in (tmp_path / "main" / "commits").iterdir() if "draft" in p.name]


@pytest.mark.parametrize("same_bucket", [False, True])
def test_writers_of_buckets_meet(spark, tmp_path, monkeypatch, same_bucket):
    path = str(tmp_path / "main")
    tables.upsert_main(batch(spark, range(60), "old"), path, bucket_rows=10)
    hashes = {r[0]: r[1] for r in batch(spark, range(60), "").select("url", F.pmod(F.xxhash64("url"), F.lit(8))).collect()}
    other = next(int(u[1:]) for u, b in hashes.items() if u != "u7" and (b == hashes["u7"]) == same_bucket)
    real, calls = tables.commit, []

    def late(spark_, path_, new):
        calls.append(new.number)
        if len(calls) == 1:
            tables.upsert_main(batch(spark, [other], "other"), path, bucket_rows=10)
        return real(spark_, path_, new)

    monkeypatch.setattr(tables, "commit", late)
    tables.upsert_main(batch(spark, [7], "mine"), path, bucket_rows=10)
    got = {r.url: r.title for r in tables.read_snapshot(spark, path).collect()}
    assert len(got) == 60 and got["u7"] == "mine 7" and got[f"u{other}"] == f"other {other}"
    assert calls == [2, 2, 3]


def test_rename_that_must_not_replace(spark, tmp_path):
    """The way of other file systems than local ones."""
    rename = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    conf = spark._jsc.hadoopConfiguration()
    make = spark._jvm.org.apache.hadoop.fs.Path
    for name in "abc":
        (tmp_path / name).write_text(name)
    at = [make(str(tmp_path / name)) for name in ("a", "b", "d")]
    files = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(at[0].toUri(), conf)
    files.rename(at[0], at[2], rename)
    with pytest.raises(Exception, match="FileAlreadyExists"):
        files.rename(at[1], at[2], rename)
    assert (tmp_path / "d").read_text() == "a"


def test_a_large_bucket_is_written_by_several_tasks_and_many_small_ones_by_few(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "PART_ROWS", 20)
    path = str(tmp_path / "large")
    rows = batch(spark, range(400), "t")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.upsert_main(rows, path)
        tables.append_main(rows, f"{path}-append")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for at in (path, f"{path}-append"):
        assert tables.version(spark, at).buckets == 1
        files = tables.read_snapshot(spark, at).groupBy(F.input_file_name()).count().collect()
        assert len(files) > 3 and max(r["count"] for r in files) < 200 and sum(r["count"] for r in files) == 400
    assert content(tables.read_snapshot(spark, path)) == content(upsert(rows, None))
    tables.upsert_main(rows, f"{path}-small", bucket_rows=4)
    assert tables.version(spark, f"{path}-small").buckets == 128
    writers = {re.search(r"part-(\d+)", f)[1] for f in tables.read_snapshot(spark, f"{path}-small").inputFiles()}
    assert len(writers) <= 8  # the tasks of a shuffle, not one for each bucket
