import functools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from custvalue.operators import profile


@pytest.mark.parametrize(
    "values",
    [
        [1, 2, 4, 9],
        [7],
        [5] * 999 + [-3],
        list(range(-2_000_000, 2_000_000, 1237)),
        [2**62, 2**62, -(2**62), 5],
        [-(2**50), -(2**41), -1, 0, 3, 2**30, 2**44, 2**50 + 1],
    ],
)
def test_describe_matches_pandas(spark, values):
    frame = pd.DataFrame({"v": values})
    got = profile.describe(spark.createDataFrame(frame).repartition(4), "v").first().asDict()
    want = frame["v"].describe()
    names = {"25%": "p25", "50%": "p50", "75%": "p75"}
    for name, value in want.items():
        key = names.get(name, name)
        if np.isnan(value):
            assert got[key] is None
        else:
            assert got[key] == pytest.approx(value, rel=1e-9), name


def test_describe_money_and_nulls(spark):
    rng = np.random.default_rng(1)
    money = np.round(rng.lognormal(6, 2, 5000), 2)
    df = spark.createDataFrame(pd.DataFrame({"v": money})).union(
        spark.range(3).select(F.lit(None).cast("double"))
    )
    got = profile.describe(df, "v").first()
    want = pd.Series(money).describe()
    assert got["count"] == 5000
    assert got.p25 == pytest.approx(want["25%"], rel=1e-12)
    assert got["std"] == pytest.approx(want["std"], rel=1e-9)


@pytest.mark.parametrize(
    "values",
    [
        [0.19, 0.29, 0.99, 1.5],
        [0.1234, 0.1249],
        [-1e300, -1.0, -0.0, 0.0, 1e-300, 2.0**-1022, 1.0, 1.0000000000000002, 2.0, 1e300],
        [2.0**k for k in range(-1000, 1000, 37)],
    ],
)
def test_no_decimal_is_cut(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double")
    got = profile.describe(df, "v").first()
    assert got["count"] == len(values)
    assert (got["min"], got["max"]) == (min(values), max(values))
    assert got["mean"] == pytest.approx(np.mean(values), rel=1e-12)
    assert [got.p25, got.p50, got.p75] == pytest.approx(list(np.quantile(values, [0.25, 0.5, 0.75])))


def test_key_has_the_order_of_the_values(spark):
    rng = np.random.default_rng(3)
    values = np.sort(np.concatenate([rng.normal(size=500), np.exp(rng.uniform(-600, 600, 500)), 2.0 ** np.arange(-50, 50)]))
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    keys = [r.k for r in df.select("v", profile.ordered_key(F.col("v")).alias("k")).orderBy("v").collect()]
    assert all(a < b for a, b in zip(keys, keys[1:]))


def test_describe_empty(spark):
    got = profile.describe(spark.createDataFrame([], "v bigint"), "v").first()
    assert got["count"] == 0 and got.p50 is None and got["std"] is None


def test_quantiles(spark):
    df = spark.range(101)
    got = {r.q: r.value for r in profile.quantiles(df, "id", [0.0, 0.1, 0.999, 1.0]).collect()}
    assert got == {0.0: 0.0, 0.1: 10.0, 0.999: pytest.approx(99.9), 1.0: 100.0}


def test_histogram_counts_all_rows_within_limits(spark):
    df = spark.range(-10, 50).select(F.col("id").cast("double").alias("v"))
    bins = profile.histogram(df, "v", 0, 30, 7).orderBy("bin").collect()
    assert [(r.bin, r.bin_start, r.n) for r in bins] == [
        (0, 0.0, 7), (1, 7.0, 7), (2, 14.0, 7), (3, 21.0, 7), (4, 28.0, 3),
    ]


def test_density_integrates_to_one(spark):
    df = spark.range(2000).select((F.randn(5) * 10).alias("v"))
    curve = profile.density(df, "v", -100, 100, 1.0, 201).collect()
    assert sum(r.density for r in curve) == pytest.approx(1.0, abs=1e-3)


def test_sketches_merge_and_are_near(spark):
    rng = np.random.default_rng(2)
    values = rng.lognormal(3, 2, 60_000)
    rows = spark.createDataFrame(
        [(float(v), int(v) % 50, None if i % 7 else float(v), None, float("nan")) for i, v in enumerate(values)],
        "a double, b int, c double, d double, e double",
    ).repartition(9).cache()
    names = ["a", "b", "c", "d", "e"]
    batch = F.pmod(F.xxhash64("a"), F.lit(5))
    parts = [profile.sketches(rows.where(batch == i), names) for i in range(5)]
    parts += [profile.sketches(rows.limit(0), names)]
    merged = profile.merge_sketches(functools.reduce(lambda x, y: x.unionByName(y), parts))
    described = profile.describe_sketches(merged).cache()
    found = {r["column"]: r for r in described.collect()}
    assert found["a"]["count"] == found["b"]["count"] == 60_000
    assert (found["a"]["min"], found["a"]["max"]) == (values.min(), values.max())
    assert found["a"]["mean"] == pytest.approx(values.mean(), rel=1e-9)
    assert found["c"]["count"] == len(values[::7])
    assert found["d"]["count"] == found["e"]["count"] == 0 and found["d"]["p50"] is None
    errors = profile.rank_errors(rows, described).collect()
    assert len(errors) == 9 and max(r["error"] for r in errors) <= profile.RANK_ERROR
    # One pass: a single scan and exchange, whatever the number of columns.
    plan = profile.sketches(rows, names)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange SinglePartition") == 1
