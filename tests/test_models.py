import numpy as np
import pytest
from pyspark.sql import functions as F

from custvalue.operators import split
from custvalue.operators.metrics import evaluation_report
from custvalue.plans import models, pipeline, tune
from custvalue.sources import readers, schemas, sinks


@pytest.fixture(scope="module")
def labelled(feature_rows, params):
    rows = split.with_split(feature_rows, params).cache()
    yield rows
    rows.unpersist()


def matrix(df, names):
    return df.select(*names).toPandas().to_numpy(dtype=float)


def test_least_squares_matches_numpy(labelled):
    train, test = (labelled.where(F.col("split") == s) for s in ("train", "test"))
    model = models.fit_model(models.LEAST_SQUARES, train)
    x, y = matrix(train, schemas.used_columns()), matrix(train, [schemas.TARGET])[:, 0]
    design = np.column_stack([np.ones(len(x)), x])
    weights = np.linalg.lstsq(design, y, rcond=None)[0]
    terms = models.linear_terms(model)
    assert [name for name, _ in terms] == ["intercept", *schemas.used_columns()]
    fitted = design @ np.array([w for _, w in terms])
    assert fitted == pytest.approx(design @ weights, rel=1e-6)
    xt, yt = matrix(test, schemas.used_columns()), matrix(test, [schemas.TARGET])[:, 0]
    want = np.sqrt(np.mean((np.column_stack([np.ones(len(xt)), xt]) @ weights - yt) ** 2))
    report = {r.split: r for r in models.evaluate_splits(model, labelled).collect()}
    assert report["test"].rmse == pytest.approx(want, rel=1e-6)
    assert report["test"].n == len(yt)


@pytest.mark.parametrize("model_type", ["DNNRegressor", models.ABSOLUTE_ERROR])
def test_trees_learn_more_than_the_mean(labelled, model_type):
    options = models.FitOptions(max_iter=5, max_depth=3)
    train = labelled.where("split = 'train'")
    model = models.fit_model(model_type, train, options)
    fit = evaluation_report(models.score(model, train), models.PREDICTION, schemas.TARGET).first()
    assert fit.r2 > 0.3


def test_penalty_removes_terms(labelled):
    model = models.fit_model(
        models.LEAST_SQUARES, labelled.where("split = 'train'"), models.FitOptions(l1=5000.0)
    )
    assert sum(w != 0 for _, w in models.linear_terms(model)) < 10


def test_unknown_type():
    with pytest.raises(ValueError):
        models.pipeline("other")


def test_versions_are_numbers(spark, labelled, tmp_path):
    train = labelled.where("split = 'train'")
    base = str(tmp_path / "export")
    first = models.fit_or_resume(models.WIDE, train, base, version=9)
    models.fit_or_resume(models.LEAST_SQUARES, train, base, version=10)
    assert sinks.latest_version(spark, base).first().version == 10
    latest = models.load_latest(spark, base)
    assert len(models.linear_terms(latest)) == 10
    resumed = models.fit_or_resume(models.WIDE, train, base, version=11, resume=True)
    assert len(models.linear_terms(resumed)) == 10
    assert len(models.linear_terms(first)) == 3


def test_resume_without_a_version_fits(labelled, tmp_path):
    train = labelled.where("split = 'train'")
    model = models.fit_or_resume(models.WIDE, train, str(tmp_path / "none"), 1, resume=True)
    assert len(model.stages) == 3


def test_draws():
    one = tune.draw_trials(tune.LINEAR_SPACE | tune.TREE_SPACE, 400, seed=1)
    assert one == tune.draw_trials(tune.LINEAR_SPACE | tune.TREE_SPACE, 400, seed=1)
    assert all(0.0001 <= t.l1 <= 0.1 and 0.05 <= t.step_size <= 0.4 for t in one)
    assert {t.max_depth for t in one} == {2, 3, 4, 5}
    # Reverse log: most draws lie near the top.
    assert np.median([t.l1 for t in one]) > 0.09


def test_tune_picks_the_least_error(labelled):
    best, trials = tune.tune(models.LEAST_SQUARES, labelled, tune.LINEAR_SPACE, 4, parallelism=2)
    rows = trials.orderBy("rmse").collect()
    assert len(rows) == 4 and rows[0].l1 == best.l1 and rows[0].l2 == best.l2


@pytest.mark.parametrize("model_type", [models.LEAST_SQUARES, "bgnbd_model"])
def test_build_then_serve(spark, params, tmp_path, model_type):
    from custvalue.plans import catalog

    source = catalog._all_lines(spark, "/root/testdata/sf0.001")
    root = str(tmp_path / "run")
    report = pipeline.build(source, params, root, model_type)
    assert all(r.rmse > 0 for r in report.collect())
    rows = spark.read.parquet(f"{root}/features_n_target")
    if model_type == "bgnbd_model":
        back = readers.read_features(spark, f"{root}/btyd.csv")
        assert back.exceptAll(rows).count() == 0
        predicted = spark.read.option("header", True).csv(f"{root}/predictions.csv")
        assert predicted.count() == rows.count()
        return
    train = readers.read_split(spark, root, "train")
    assert train.count() == split.split_rows(rows, params, "train").count()
    scoring = rows.select(*schemas.SCORING.fieldNames())
    out = str(tmp_path / "served")
    model = models.load_latest(spark, f"{root}/export")
    predictions = pipeline.predict_serve(spark, model, scoring, out)
    assert predictions.count() == rows.count()
    assert predictions.where("predicted_monetary IS NULL").count() == 0
    assert spark.read.text(f"{out}/entities").count() == rows.count()
    assert spark.read.text(f"{out}/errors").count() == 0
    assert readers.shard_names(spark.read.text(f"{out}/output")).count() >= 1


def test_crosses_are_saved_with_the_model(labelled, tmp_path):
    from custvalue.plans import catalog

    train = labelled.where("split = 'train'")
    plain = models.fit_model(models.WIDE, train)
    crossed = models.fit_model(
        models.WIDE, train, models.FitOptions(l2=0.01), crosses=(catalog.CROSS,)
    )
    assert crossed.stages[-1].numFeatures == 2 + 120
    score = lambda m: evaluation_report(
        models.score(m, train), models.PREDICTION, schemas.TARGET
    ).first()
    assert score(crossed).rmse < score(plain).rmse
    models.save_version(crossed, str(tmp_path), 3)
    again = models.load_latest(labelled.sparkSession, str(tmp_path))
    assert score(again).rmse == pytest.approx(score(crossed).rmse)
