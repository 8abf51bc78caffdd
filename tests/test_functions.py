"""Shared folder and rounding helpers."""

import os
import types

import pytest
from pyspark.sql import functions as F

from custvalue.functions import numeric, scratch


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def session(master, named=None, folder=None):
    conf = types.SimpleNamespace(get=lambda key, default: named or default)
    return types.SimpleNamespace(conf=conf, sparkContext=Context(master, folder))


def test_folder_named_by_the_cluster_comes_first():
    assert scratch.shared_dir(session("yarn", named="hdfs:///ck/", folder="x")) == "hdfs:///ck"
    assert scratch.shared_dir(session("yarn", folder="hdfs:///set")) == "hdfs:///set"


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        scratch.shared_dir(session("yarn"))
    local = session("local[2]")
    assert scratch.shared_dir(local) == scratch.shared_dir(local)


def test_settled_rows_have_no_lineage(spark):
    df = spark.range(100).withColumn("x", F.rand(1))
    settled = scratch.settle(df)
    assert sorted(settled.collect()) == sorted(df.collect())
    plan = settled.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "x" not in plan.split("ReadSchema")[1]


def test_owner_clears_the_folder(spark):
    settled = scratch.settle(spark.range(3))
    path = settled.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path)
    other = os.path.join(scratch.shared_dir(spark), "other.txt")
    open(other, "w").close()
    scratch.clear(spark)
    assert not os.path.exists(path) and os.path.exists(other)


@pytest.mark.parametrize(
    "value,digits,want",
    [
        (1.005, 2, 1.0), (2.5, 0, 3.0), (-2.5, 0, -3.0), (0.125, 2, 0.13), (-0.125, 2, -0.13),
        (1e300, 2, 1e300), (-9.1e18, 2, -9.1e18), (None, 2, None), (0.0, 2, 0.0),
    ],
)
def test_round_half_away(spark, value, digits, want):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(numeric.round_half_away(F.col("v"), digits)).first()[0] == want


def test_units_and_cents(spark):
    df = spark.createDataFrame([(149,), (150,), (-149,), (-150,), (0,), (9_000_000_000_000_000_049,)], "u bigint")
    got = [r[0] for r in df.select(numeric.units_to_cents(F.col("u"))).collect()]
    assert got == [1, 2, -1, -2, 0, 90_000_000_000_000_000]


def test_overflow_is_an_error(spark):
    df = spark.createDataFrame([(1e12, 10**12)], "p double, q bigint")
    with pytest.raises(Exception, match="OVERFLOW"):
        df.select(numeric.line_units(F.col("p"), F.col("q"))).collect()
