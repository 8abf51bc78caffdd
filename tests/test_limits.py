"""No silent cut, cap or default: extreme inputs give exact results, NULLs or errors."""

import dataclasses
import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from custvalue.functions import numeric, special
from custvalue.operators import btyd, clean, features
from custvalue.operators.metrics import evaluation_report
from custvalue.plans import catalog, fit, models, tune
from custvalue.sources import schemas, sinks

FOLDER = "/root/testdata/sf0.01"


def test_prices_beyond_the_digits_stop_the_job(spark):
    df = spark.createDataFrame([(0.00004, 1_000_000), (1.23456, 1000), (None, 3)], "p double, q bigint")
    fine = df.select(numeric.line_units(F.col("p"), F.col("q"), 5).alias("u")).collect()
    assert [r.u for r in fine] == [4_000_000, 123_456_000, None]
    cents = df.select(numeric.units_to_cents(numeric.line_units(F.col("p"), F.col("q"), 5), 5).alias("c"))
    assert [r.c for r in cents.collect()] == [4000, 123_456, None]
    with pytest.raises(Exception, match="more than 4 decimals"):
        df.select(numeric.line_units(F.col("p"), F.col("q"))).collect()


def test_price_digits_of_a_run(spark, params):
    lines = spark.createDataFrame(
        [("1", "01/02/00 10:00", 1000, 1.23456), ("1", "01/02/00 11:00", 1_000_000, 0.00004)],
        "CustomerID string, InvoiceDate string, Quantity bigint, UnitPrice double",
    )
    finer = dataclasses.replace(params, price_digits=5)
    assert clean.daily_orders(lines, finer).first()["order_value"] == 1274.56
    with pytest.raises(Exception, match="more than 4 decimals"):
        clean.daily_orders(lines, params).collect()


@pytest.mark.parametrize(
    "model", [btyd.BgNbd(1.5, 300.0, 0.8, 2.5), btyd.ParetoNbd(1.5, 300.0, 0.6, 400.0)]
)
def test_unknown_customers_stay_unknown(spark, model):
    rows = [(None, None, None), (2, None, 90), (2, 30, 90), (0, 0, 90)]
    df = spark.createDataFrame(rows, "x bigint, tx bigint, T bigint")
    columns = [F.col(c) for c in ("x", "tx", "T")]
    got = df.select(
        model.p_alive(*columns).alias("alive"), model.expected_purchases(100.0, *columns).alias("e")
    ).collect()
    assert [r.alive is None for r in got] == [True, True, False, False]
    assert [r.e is None for r in got] == [True, True, False, False]


def test_spend_that_the_model_cannot_hold_is_refused(spark):
    df = spark.createDataFrame([(3, 10.0), (2, 0.0), (1, None), (0, 0.0)], "frequency bigint, monetary_value double")
    with pytest.raises(ValueError, match="2 repeat customers"):
        fit.fit_gamma_gamma(df)


def test_a_fit_without_a_minimum_raises(spark):
    rng = np.random.default_rng(1)
    rows = [(int(x), float(m)) for x, m in zip(rng.integers(1, 9, 200), rng.gamma(2.0, 20.0, 200))]
    df = spark.createDataFrame(rows, "frequency bigint, monetary_value double")
    with pytest.raises(fit.NotConverged, match="rounds after 1 rounds"):
        fit.fit_gamma_gamma(df, rounds=1)
    found = fit.fit_gamma_gamma(df)
    assert found.status in ("converged", "boundary") and found.rounds > 1
    assert found.gradient_norm < 1e-2


def test_descent_tells_how_it_ended():
    def power(n):
        def evaluate(points):
            away = points - 3
            return [fit.Slope((p**n).sum(), n * p ** (n - 1), np.diag(n * (n - 1) * p ** (n - 2))) for p in away]

        return evaluate

    bowl = fit.minimise(power(2), np.zeros(2))
    assert bowl.status == "converged" and bowl.point == pytest.approx([3, 3], abs=1e-3)
    assert fit.minimise(power(4), np.zeros(2), rounds=2).status == "rounds"
    far = fit.minimise(lambda p: [fit.Slope(np.exp(-x[0]), -np.exp(-x), np.diag(np.exp(-x))) for x in p], np.zeros(1))
    assert far.status == "boundary"


def test_iterations_are_taken_as_given():
    for kind, default in ((models.LEAST_SQUARES, 100), (models.ABSOLUTE_ERROR, 20), (models.FACTORIZATION, 100)):
        def steps(options, kind=kind):
            return max(s.getMaxIter() for s in models.pipeline(kind, options).getStages() if hasattr(s, "getMaxIter"))

        assert steps(models.FitOptions(max_iter=3)) == 3
        assert steps(models.FitOptions()) == default


def test_later_target_needs_a_later_order(spark, params):
    import datetime as dt

    after = dataclasses.replace(params, target_window="after")
    early = [dt.date(2000, 1, d) for d in (3, 9, 20)]
    rows = [(c, d, 10.0, 1) for c in ("a", "b") for d in early] + [("b", dt.date(2000, 9, 1), 7.5, 1)]
    cleaned = spark.createDataFrame(rows, "customer_id string, order_date date, order_value double, order_qty_articles bigint")
    assert [r.customer_id for r in features.target(cleaned, after).collect()] == ["b"]
    found = features.features_n_target(cleaned, after).collect()
    assert [(r.customer_id, r.target_monetary) for r in found] == [("b", 7.5)]
    assert features.features_rfm(cleaned, after).count() == 2


def test_unknown_labels_stay_out_of_metrics(spark, feature_rows):
    model = models.fit_model(models.LEAST_SQUARES, feature_rows)
    unknown = feature_rows.withColumn(schemas.TARGET, F.when(F.col("customer_id") > "5", F.col(schemas.TARGET)))
    scored = models.score(model, unknown)
    assert scored.where(F.col(schemas.TARGET).isNull()).count() == unknown.where(F.col(schemas.TARGET).isNull()).count() > 0
    report = evaluation_report(scored, models.PREDICTION, schemas.TARGET).first()
    assert report.n == unknown.where(F.col(schemas.TARGET).isNotNull()).count()


@pytest.mark.parametrize("a,b,r,alpha", [(0.8, 2.5, 1.5, 300.0), (2.2, 1.1, 0.4, 3.0), (0.01, 0.5, 0.9, 50.0)])
def test_long_horizons_agree_with_integration(spark, a, b, r, alpha):
    def slow(x, age, t):
        """By the substitution p = w ** (4 / a), which takes the peak at zero away."""
        w = (np.arange(1_000_000) + 0.5) / 1_000_000
        p = np.maximum(w ** (4 / a), 1e-290)
        g = -np.expm1(-(r + x) * np.log1p(p * t / (alpha + age))) / p
        log_beta = math.lgamma(a) + math.lgamma(b + x) - math.lgamma(a + b + x)
        return np.mean(4 / a * w**3 * g * np.exp((b + x - 1) * np.log1p(-p) - log_beta))

    rows = [(x, float(age)) for x in (1, 4, 30) for age in (1.0, 200.0)]
    df = spark.createDataFrame(rows, "x bigint, T double")
    for t in (100.0, 3600.0, 40_000.0):
        kernel = special.dropout_purchases(r, alpha, a, b, [t], [1.0])
        got = [v for (v,) in df.select(kernel("x", "T")).collect()]
        assert got == pytest.approx([slow(x, age, t) for x, age in rows], rel=1e-5)


def test_series_and_quadrature_meet(spark):
    x = spark.createDataFrame([(k, 10.0) for k in range(0, 40, 3)], "x bigint, T double")
    alpha = 20.0
    for a in (0.8, 1.0, 3.5):
        near, far = (t * (alpha + 10.0) for t in (8.9999999, 9.0000001))
        low, high = (
            [v for (v,) in x.select(special.dropout_purchases(1.2, alpha, a, 2.0, [t], [1.0])("x", "T")).collect()]
            for t in (near, far)
        )
        assert low == pytest.approx(high, rel=1e-6)


def test_work_of_a_row_is_bounded(spark):
    kernel = special.dropout_purchases(1.5, 300.0, 0.8, 2.5, [1.0], [1.0]).func
    import pandas as pd

    x, age = pd.Series(np.arange(10_000) % 50), pd.Series(np.full(10_000, 100.0))
    for t in (1e3, 1e7, 4e14):  # z up to 1 - 1e-12
        kernel = special.dropout_purchases(1.5, 300.0, 0.8, 2.5, [t], [1.0]).func
        start = time.process_time()
        found = kernel(x, age)
        assert time.process_time() - start < 5
        assert found.notna().all() and np.isfinite(found.to_numpy(dtype=float)).all()


def test_scans_of_plans_with_a_minimum_of_their_own(spark):
    def scans(df):
        return df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")

    # The customers are written once; the rows and their minimum read that table.
    assert scans(catalog.baseline_predictions(spark, FOLDER)) == 2
    assert scans(catalog.monetary_density(spark, FOLDER)) == 2
    assert scans(catalog.explore_day_number(spark, FOLDER)) <= 7


def test_factorization_beats_the_mean(spark):
    for row in catalog.fit_factorization(spark, FOLDER).collect():
        assert row.r2 > 0


def test_newest_finished_version_right_under_the_base(spark, tmp_path):
    base = f"{tmp_path}/version=7/export"
    assert sinks.latest_version(spark, base).first()[0] is None
    for version in (1, 12):
        spark.range(1).write.parquet(f"{base}/version={version}")
    spark.range(1).write.parquet(f"{base}/version=3/version=99")
    (tmp_path / "version=7" / "export" / "version=40").mkdir()  # nothing finished in it
    assert sinks.latest_version(spark, base).first()[0] == 12


def test_search_needs_rows_to_choose_by(spark, feature_rows):
    labelled = feature_rows.withColumn("split", F.lit("train"))
    with pytest.raises(ValueError, match="evaluation split"):
        tune.tune(models.LEAST_SQUARES, labelled, tune.LINEAR_SPACE, 2)
    with pytest.raises(ValueError, match="metric"):
        tune.tune(models.LEAST_SQUARES, labelled, tune.LINEAR_SPACE, 2, metric="r2")


def test_crossed_slots_are_those_of_the_models(spark, feature_rows):
    rows = feature_rows.withColumn("frequency_dnn", F.when(F.col("customer_id") > "5", 40).otherwise(F.col("frequency_dnn")))
    model = models.pipeline(models.WIDE, crosses=(catalog.CROSS,)).getStages()
    encoded = rows
    for stage in model[1:4]:
        encoded = stage.transform(encoded)
    for row in encoded.select("cross_0_slot", "cross_0", "frequency_dnn").collect():
        want = [] if row.cross_0_slot is None else [row.cross_0_slot]
        assert list(row.cross_0.indices) == want and row.cross_0.size == 120
        assert row.frequency_dnn < 12 or row.cross_0_slot is None
