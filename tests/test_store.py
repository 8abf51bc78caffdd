import os

import pytest
from pyspark.sql import functions as F

from custvalue.plans import models
from custvalue.sources import sinks
from custvalue.sources.store import Conflict, KeyedStore

SCHEMA = "name string, value double, note string"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def store(spark, tmp_path):
    return KeyedStore(spark, str(tmp_path / "store"), "name", buckets=8)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_upserts_are_read_back(spark, store):
    first = [(f"k{i}", float(i), None) for i in range(200)]
    assert store.upsert(frame(spark, *first)) == 1
    again = [(f"k{i}", -1.0, "new") for i in range(150, 210)] + [(None, 5.0, "no key")]
    assert store.upsert(frame(spark, *again)) == 2
    assert rows_of(store.read()) == sorted(first[:150] + again, key=repr)
    assert rows_of(store.read(version=1)) == sorted(first, key=repr)
    assert rows_of(store.lookup("k160")) == [("k160", -1.0, "new")]
    assert rows_of(store.lookup(None)) == [(None, 5.0, "no key")]
    assert rows_of(store.lookup("absent")) == []


def test_only_touched_buckets_are_written_and_one_is_looked_up(spark, store):
    store.upsert(frame(spark, *[(f"k{i}", float(i), None) for i in range(200)]))
    before = store._manifest(1)["folders"]
    store.upsert(frame(spark, ("k3", 7.0, "x")))
    after = store._manifest(2)["folders"]
    assert len(before) == 8 and sum(before[b] != after[b] for b in before) == 1
    files = store.lookup("k3").inputFiles()
    assert len({os.path.dirname(f) for f in files}) == 1


def test_repeated_keys_within_a_change(spark, store):
    store.upsert(frame(spark, ("a", 1.0, "x"), ("a", 2.0, "b"), ("a", 2.0, "c"), ("a", None, "z"), (None, 1.0, None), (None, 1.0, None)))
    assert rows_of(store.read()) == [("a", 2.0, "c"), (None, 1.0, None)]


def test_a_failed_write_leaves_the_old_state(spark, store):
    store.upsert(frame(spark, ("a", 1.0, None)))
    bad = frame(spark, ("a", 2.0, None)).withColumn("value", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        store.upsert(bad)
    with pytest.raises(Exception, match="lost"):
        store.replace(bad)
    with pytest.raises(ValueError, match="columns of the store"):
        store.upsert(frame(spark, ("a", 1.0, None)).drop("note"))
    assert store.version() == 1 and rows_of(store.read()) == [("a", 1.0, None)]


def test_the_second_of_two_writers_is_refused(spark, store, monkeypatch):
    store.upsert(frame(spark, ("a", 1.0, None)))
    other = KeyedStore(spark, store.path, "name")
    write = other._write

    def meanwhile(*given):
        store.upsert(frame(spark, ("b", 2.0, None)))
        return write(*given)

    monkeypatch.setattr(other, "_write", meanwhile)
    with pytest.raises(Conflict):
        other.upsert(frame(spark, ("a", 9.0, None)))
    assert rows_of(store.read()) == [("a", 1.0, None), ("b", 2.0, None)]


def test_replacement_and_pruning(spark, store):
    for n in range(3):
        store.replace(frame(spark, (f"only {n}", float(n), None)))
    assert rows_of(store.read()) == [("only 2", 2.0, None)] and store.version() == 3
    store.prune(keep=1)
    assert rows_of(store.read()) == [("only 2", 2.0, None)]
    assert len(store._listed("data")) == 1 and len(store._listed("manifests")) == 1
    store.replace(frame(spark).limit(0))
    assert rows_of(store.read()) == []


def test_nothing_written(spark, store):
    with pytest.raises(FileNotFoundError):
        store.read()
    with pytest.raises(FileNotFoundError):
        store.lookup("a")


def test_only_the_latest_exports_are_kept(spark, tmp_path):
    base = str(tmp_path / "export")
    for version in (2, 9, 10):
        spark.range(1).write.parquet(sinks.version_path(base, version))
        sinks.mark_complete(spark, sinks.version_path(base, version))
    os.makedirs(sinks.version_path(base, 11))  # one that is being written
    sinks.keep_latest(spark, base, 2)
    assert sorted(os.listdir(base)) == ["version=10", "version=11", "version=9"]
    assert models.has_version(spark, base)
