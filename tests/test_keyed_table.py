"""Versions of a keyed table: whole or absent, replayed, with a large bucket."""

from pathlib import Path

import pytest
from lakeprofile.operators import keyed_table
from pyspark.sql import functions as F

SCHEMA = "k string, at int, v string"


def rows(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


def state(spark, path, schema, version=None):
    return sorted(tuple(r) for r in keyed_table.read(spark, path, schema, version).collect())


def test_versions_merge_and_replay(spark, tmp_path):
    path = str(tmp_path / "t")
    first = rows(spark, *[(f"k{i}", 1, "old") for i in range(20)], (None, 1, "null key"))
    keyed_table.create(first, path, "k", 4)
    update = rows(spark, ("k1", 2, "new"), ("k1", 3, "newest"), ("k2", 0, "stale"), ("x", 1, "added"), (None, 2, "null key again"))
    assert keyed_table.merge(update, path, "k", "at", 4, tag="b0") == 1
    assert keyed_table.merge(update, path, "k", "at", 4, tag="b0") == 1  # done already
    want = sorted([(f"k{i}", 1, "old") for i in range(20) if i != 1] + [("k1", 3, "newest"), ("x", 1, "added"), (None, 2, "null key again")], key=str)
    assert sorted(map(tuple, keyed_table.read(spark, path, first.schema).collect()), key=str) == want
    assert keyed_table.read(spark, path, first.schema, 0).count() == 21
    assert keyed_table.merge(update, path, "k", "at", 4) == 2  # untagged: the same rows again
    assert sorted(map(tuple, keyed_table.read(spark, path, first.schema).collect()), key=str) == want


def test_only_touched_buckets_are_written(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed_table.create(rows(spark, *[(f"k{i}", 1, "old") for i in range(200)]), path, "k", 8)
    keyed_table.merge(rows(spark, ("k3", 2, "new")), path, "k", "at", 8)
    assert len(list((tmp_path / "t" / "data" / "version=0").glob("bucket=*"))) == 8
    assert len(list((tmp_path / "t" / "data" / "version=1").glob("bucket=*"))) == 1


@pytest.mark.parametrize("at", ["data", "manifest"])
def test_a_writer_that_dies_changes_nothing(spark, tmp_path, monkeypatch, at):
    """Readers keep the old version until the manifest is there; the next writer replaces what was left."""
    path = str(tmp_path / "t")
    first = rows(spark, *[(f"k{i}", 1, "old") for i in range(50)])
    keyed_table.create(first, path, "k", 4)
    before = state(spark, path, first.schema)
    update = rows(spark, *[(f"k{i}", 2, "new") for i in range(50)])
    writer = type(first.write)
    plain = writer.parquet if at == "data" else writer.json

    def dies(self, target, *rest, **more):
        if at == "data":
            plain(self, target, *rest, **more)
            assert state(spark, path, first.schema) == before  # new folders are there, the version is not
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(writer, "parquet" if at == "data" else "json", dies)
        with pytest.raises(RuntimeError, match="lost"):
            keyed_table.merge(update, path, "k", "at", 4)
    assert state(spark, path, first.schema) == before
    assert keyed_table.merge(update, path, "k", "at", 4) == 1
    assert {v for _, _, v in state(spark, path, first.schema)} == {"new"}


def test_a_reader_keeps_its_version_while_others_merge(spark, tmp_path):
    path = str(tmp_path / "t")
    first = rows(spark, *[(f"k{i}", 1, "old") for i in range(50)])
    keyed_table.create(first, path, "k", 4)
    held = keyed_table.read(spark, path, first.schema)
    keyed_table.merge(rows(spark, *[(f"k{i}", 2, "new") for i in range(50)]), path, "k", "at", 4)
    assert {r["v"] for r in held.collect()} == {"old"}
    assert {r["v"] for r in keyed_table.read(spark, path, first.schema).collect()} == {"new"}


def test_two_writers_of_a_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    keyed_table.create(rows(spark, ("a", 1, "x")), path, "k", 2)
    monkeypatch.setattr(keyed_table, "newest", lambda *a: 0)
    keyed_table.merge(rows(spark, ("a", 2, "y")), path, "k", "at", 2)
    with pytest.raises(Exception, match="already exists"):
        keyed_table.merge(rows(spark, ("a", 3, "z")), path, "k", "at", 2)


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    """One of two buckets holds nine rows in ten."""
    path = str(tmp_path / "t")
    many = spark.range(40_000).select(F.concat(F.lit("k"), "id").alias("k"), F.lit(1).alias("at"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    placed = many.withColumn("b", keyed_table.bucket_of("k", 2))
    lopsided = placed.where((F.col("b") == 0) | (F.xxhash64("k", F.lit("thin")) % 9 == 0)).drop("b")
    keyed_table.create(lopsided, path, "k", 2, file_rows=3_000)
    files = {b: len(list(Path(path, "data", "version=0", f"bucket={b}").glob("*.parquet"))) for b in (0, 1)}
    assert files[0] >= 5 and files[1] <= 2, files
    largest = keyed_table.read(spark, path, many.schema).groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert largest < 9_000
    assert keyed_table.read(spark, path, many.schema).count() == lopsided.count()


def test_vacuum(spark, tmp_path):
    path = str(tmp_path / "t")
    first = rows(spark, *[(f"k{i}", 1, "old") for i in range(50)])
    keyed_table.create(first, path, "k", 4)
    for n in (2, 3, 4):
        keyed_table.merge(rows(spark, *[(f"k{i}", n, f"v{n}") for i in range(50)]), path, "k", "at", 4)
    now = state(spark, path, first.schema)
    assert set(keyed_table.vacuum(spark, path, versions=2)) == {"manifest/version=0", "manifest/version=1", "data/version=0", "data/version=1"}
    assert state(spark, path, first.schema) == now and state(spark, path, first.schema, 2)
    assert keyed_table.vacuum(spark, path, versions=2) == []


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "t")
    none = rows(spark).limit(0)
    keyed_table.create(none, path, "k", 4)
    assert state(spark, path, none.schema) == []
    assert keyed_table.merge(none, path, "k", "at", 4) == 1 and state(spark, path, none.schema) == []
    keyed_table.merge(rows(spark, ("a", 1, "x")), path, "k", "at", 4)
    assert state(spark, path, none.schema) == [("a", 1, "x")]
