"""Named queries over the star-schema tables: one per operator, each over whole tables."""

from __future__ import annotations

import dataclasses
import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from custvalue.functions import hashing
from custvalue.functions.numeric import round_half_away
from custvalue.functions.scratch import scratch_path, settle
from custvalue.operators import (
    baseline,
    btyd,
    choose,
    clean,
    explore,
    features,
    featurize,
    metrics,
    moments,
    profile,
    serve,
    split,
)
from custvalue.params import ClvParams
from custvalue.plans import boost, fit, models, pipeline, ridge, tune
from custvalue.sources import readers, schemas, sinks
from custvalue.sources.star import transactions_from_star
from custvalue.sources.store import KeyedStore

PARAMS = ClvParams(threshold_date="2000-06-30", predict_end="2001-08-01", max_monetary=25000.0)
LOW_CLIPS = dataclasses.replace(PARAMS, freq_clip=10, money_clip=2000.0)
AFTER = dataclasses.replace(PARAMS, target_window="after")

BG_NBD = btyd.BgNbd(r=1.5, alpha=300.0, a=0.8, b=2.5)
PARETO_NBD = btyd.ParetoNbd(r=1.5, alpha=300.0, s=0.6, beta=400.0)
GAMMA_GAMMA = btyd.GammaGamma(p=3.0, q=5.0, v=3000.0)

RECENCY_CUTS = (250.0, 500.0, 1000.0, 1500.0)
CROSS = [
    featurize.CrossKey("recency", len(RECENCY_CUTS) + 1, RECENCY_CUTS),
    featurize.CrossKey("frequency_dnn", 12),
    featurize.CrossKey("has_returned", 2),
]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LINE_COLUMNS = ("Quantity", "InvoiceDate", "UnitPrice", "CustomerID")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return transactions_from_star(spark, folder, LINE_COLUMNS)


def _all_lines(spark: SparkSession, folder: str) -> DataFrame:
    return transactions_from_star(spark, folder)


def _units(spark: SparkSession, folder: str) -> DataFrame:
    return clean.daily_units(_lines(spark, folder), PARAMS)


def _daily(spark: SparkSession, folder: str) -> DataFrame:
    return clean.daily_orders(_lines(spark, folder), PARAMS)


def _cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return clean.clean_orders(_lines(spark, folder), PARAMS)


def _features(spark: SparkSession, folder: str) -> DataFrame:
    return features.features_n_target(_cleaned(spark, folder), PARAMS)


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    """Feature rows with their split, written once for the passes of a fit."""
    return settle(split.with_split(_features(spark, folder), PARAMS))


def _predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Baseline predictions in cents, as a stand-in for any model's output."""
    predicted = round_half_away(F.col("predicted_monetary"))
    return baseline.baseline_predictions(_cleaned(spark, folder), PARAMS).withColumn(
        "predicted_monetary", predicted
    )


def _rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: round_half_away(F.col(n), digits) for n in names})


# Sources and sinks


@query
def src_transactions(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "transactions")
    sinks.write_csv(_all_lines(spark, folder), path, header=True)
    return readers.read_transactions(spark, path)


@query
def export_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "features")
    sinks.write_csv(_features(spark, folder), path, header=True)
    return readers.read_features(spark, path)


@query
def read_split_files(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "splits")
    sinks.write_splits(_labelled(spark, folder), path)
    parts = [
        readers.read_split(spark, path, name).withColumn("split", F.lit(name))
        for name in readers.SPLITS
    ]
    return functools.reduce(DataFrame.unionByName, parts)


@query
def csv_with_defaults(spark: SparkSession, folder: str) -> DataFrame:
    """Rows without returns, or with one repeat order, leave fields empty in the file."""
    path = scratch_path(spark, "sparse")
    sparse = _features(spark, folder).withColumns(
        {
            "has_returned": F.when(F.col("has_returned") == 1, 1),
            "monetary_btyd": F.when(F.col("frequency_btyd") > 4, F.col("monetary_btyd")),
            "cnt_returns": F.when(F.col("cnt_returns") > 0, F.col("cnt_returns")),
        }
    )
    sinks.write_csv(sparse, path, header=False)
    return readers.with_defaults(readers.read_features(spark, path, header=False))


@query
def scoring_input(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "scoring")
    rows = _features(spark, folder).select(*schemas.SCORING.fieldNames())
    sinks.write_csv(rows, path, header=False)
    return readers.read_scoring(spark, path)


@query
def scoring_header(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "scoring")
    rows = _features(spark, folder).select(*schemas.SCORING.fieldNames())
    sinks.write_csv(rows, path, header=True)
    return readers.read_scoring(spark, path, header=True)


@query
def scoring_ndjson(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "scoring")
    rows = _features(spark, folder).select(*schemas.SCORING.fieldNames())
    sinks.write_json(rows, path)
    return readers.read_scoring(spark, path, fmt="json")


def _table_name(label: str) -> str:
    """A name that no other run uses."""
    return f"{label}_{uuid.uuid4().hex}"


def _and_dropped(rows: DataFrame, name: str) -> DataFrame:
    """Rows of a table that is dropped once they are written elsewhere."""
    kept = settle(rows)
    rows.sparkSession.sql(f"DROP TABLE {name}")
    return kept


@query
def table_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Features as a catalog table, read by its name and by SQL text with a parameter."""
    name = _table_name("features")
    sinks.write_table(_features(spark, folder), name)
    few = readers.query(
        spark, "SELECT * FROM IDENTIFIER(:name) WHERE frequency_dnn <= :most", name=name, most=9
    )
    return _and_dropped(few.unionByName(readers.read_table(spark, name).where("frequency_dnn > 9")), name)


@query
def predictions_table(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions loaded from their shards into a table that is replaced."""
    name = _table_name("predictions")
    loaded = predictions_load(spark, folder)
    sinks.write_table(loaded.limit(0), name)
    sinks.write_table(loaded, name)
    return _and_dropped(readers.read_table(spark, name), name)


@query
def entity_store(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions in a keyed store after a second upsert for about half of the customers."""
    store = KeyedStore(spark, scratch_path(spark, "entities"), "customer_id", buckets=16)
    rows = settle(_predictions(spark, folder).select("customer_id", "predicted_monetary"))
    store.upsert(rows)
    half = hashing.hash_bucket(F.col("customer_id"), 100_000) < 50_000
    store.upsert(rows.where(half).withColumn("predicted_monetary", F.col("predicted_monetary") + 1000))
    store.prune(keep=1)
    return _rounded(store.read(), 2, "predicted_monetary")


@query
def shard_names(spark: SparkSession, folder: str) -> DataFrame:
    """Number of prediction shards and of the names they are listed by."""
    path = scratch_path(spark, "predictions")
    rows = _predictions(spark, folder).select("customer_id", "predicted_monetary")
    sinks.write_json(rows.repartition(3, "customer_id"), path)
    names = readers.shard_names(spark.read.text(path))
    known = names.where(F.col("file_path").contains("/predictions-"))
    return known.agg(
        F.count(F.lit(1)).alias("shards"), F.countDistinct("file_path").alias("names")
    )


@query
def predictions_json(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "predictions")
    rows = _predictions(spark, folder).select("customer_id", "predicted_monetary")
    sinks.write_json(rows, path)
    return spark.read.text(path)


@query
def predictions_load(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "predictions")
    rows = _predictions(spark, folder).select("customer_id", "predicted_monetary")
    sinks.write_json(rows, path)
    return readers.read_predictions(spark, path)


@query
def latest_version(spark: SparkSession, folder: str) -> DataFrame:
    """Orders saved as one version per year; the newest version and its rows."""
    path = scratch_path(spark, "versions")
    dated = _cleaned(spark, folder).withColumn("version", F.year("order_date"))
    sinks.write_parquet(dated, path, partition_by="version")
    newest = sinks.latest_version(spark, path).first()["version"]
    rows = spark.read.parquet(sinks.version_path(path, newest))
    return rows.agg(
        F.lit(newest).cast("bigint").alias("version"), F.count(F.lit(1)).alias("n_rows")
    )


def _mixed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Prediction lines among free text that is no JSON."""
    texts = spark.read.parquet(f"{folder}/documents.parquet").select(F.col("text").alias("value"))
    return serve.prediction_lines(_predictions(spark, folder)).unionByName(texts)


@query
def entity_json(spark: SparkSession, folder: str) -> DataFrame:
    return serve.good_entities(_mixed_lines(spark, folder))


@query
def entity_errors(spark: SparkSession, folder: str) -> DataFrame:
    return serve.entity_errors(_mixed_lines(spark, folder))


# Cleaning


@query
def line_value(spark: SparkSession, folder: str) -> DataFrame:
    columns = ("InvoiceNo", "StockCode", "CustomerID", "Quantity", "UnitPrice")
    return clean.line_value(transactions_from_star(spark, folder, columns))


@query
def daily_orders(spark: SparkSession, folder: str) -> DataFrame:
    return _daily(spark, folder)


@query
def latest_order(spark: SparkSession, folder: str) -> DataFrame:
    return clean.latest_order(_daily(spark, folder))


@query
def recently_active(spark: SparkSession, folder: str) -> DataFrame:
    return clean.recently_active(_daily(spark, folder), PARAMS)


@query
def positive_days(spark: SparkSession, folder: str) -> DataFrame:
    return clean.positive_days(_units(spark, folder), PARAMS)


@query
def repeat_customers(spark: SparkSession, folder: str) -> DataFrame:
    return clean.repeat_customers(_units(spark, folder), PARAMS)


@query
def sign_consistent(spark: SparkSession, folder: str) -> DataFrame:
    return clean.sign_consistent(_daily(spark, folder))


@query
def clean_orders(spark: SparkSession, folder: str) -> DataFrame:
    return _cleaned(spark, folder)


# Features


@query
def first_order(spark: SparkSession, folder: str) -> DataFrame:
    return features.first_order(_cleaned(spark, folder))


@query
def first_order_zeroed(spark: SparkSession, folder: str) -> DataFrame:
    return features.first_order_zeroed(_cleaned(spark, folder))


@query
def target(spark: SparkSession, folder: str) -> DataFrame:
    return features.target(_cleaned(spark, folder), PARAMS)


@query
def target_after(spark: SparkSession, folder: str) -> DataFrame:
    return features.target(_cleaned(spark, folder), AFTER)


@query
def features_rfm(spark: SparkSession, folder: str) -> DataFrame:
    return features.features_rfm(_cleaned(spark, folder), PARAMS)


@query
def features_n_target(spark: SparkSession, folder: str) -> DataFrame:
    return _features(spark, folder)


@query
def features_after(spark: SparkSession, folder: str) -> DataFrame:
    """Features whose target counts later orders only; customers without one are left out."""
    return features.features_n_target(_cleaned(spark, folder), AFTER)


@query
def features_clipped(spark: SparkSession, folder: str) -> DataFrame:
    clipped = ("frequency_btyd_clipped", "monetary_btyd_clipped", "target_monetary_clipped")
    rows = features.features_n_target(_cleaned(spark, folder), LOW_CLIPS)
    return rows.select("customer_id", *clipped)


# Splits


@query
def hash_bucket(spark: SparkSession, folder: str) -> DataFrame:
    return split.with_bucket(_features(spark, folder).select("customer_id"), PARAMS)


@query
def split_train(spark: SparkSession, folder: str) -> DataFrame:
    return split.split_rows(_features(spark, folder), PARAMS, "train")


@query
def split_eval(spark: SparkSession, folder: str) -> DataFrame:
    return split.split_rows(_features(spark, folder), PARAMS, "eval")


@query
def split_test(spark: SparkSession, folder: str) -> DataFrame:
    return split.split_rows(_features(spark, folder), PARAMS, "test")


@query
def shuffled_train(spark: SparkSession, folder: str) -> DataFrame:
    return split.shuffled(split_train(spark, folder), seed=42)


# Baseline and metrics


@query
def baseline_days(spark: SparkSession, folder: str) -> DataFrame:
    return baseline.baseline_days(_cleaned(spark, folder), PARAMS)


@query
def baseline_predictions(spark: SparkSession, folder: str) -> DataFrame:
    return baseline.baseline_predictions(_cleaned(spark, folder), PARAMS)


def _baseline_metric(spark: SparkSession, folder: str, name: str, metric) -> DataFrame:
    value = metric("predicted_monetary", "target_monetary")
    return baseline_predictions(spark, folder).agg(round_half_away(value).alias(name))


@query
def baseline_rmse(spark: SparkSession, folder: str) -> DataFrame:
    return _baseline_metric(spark, folder, "rmse", metrics.rmse)


@query
def baseline_mse(spark: SparkSession, folder: str) -> DataFrame:
    return _baseline_metric(spark, folder, "mse", metrics.mse)


@query
def baseline_mae(spark: SparkSession, folder: str) -> DataFrame:
    return _baseline_metric(spark, folder, "mae", metrics.mae)


@query
def baseline_rmse_by_split(spark: SparkSession, folder: str) -> DataFrame:
    rows = split.with_split(baseline_predictions(spark, folder), PARAMS)
    error = metrics.rmse("predicted_monetary", "target_monetary")
    return rows.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), round_half_away(error).alias("rmse")
    )


@query
def evaluation_report(spark: SparkSession, folder: str) -> DataFrame:
    report = metrics.evaluation_report(
        baseline_predictions(spark, folder), "predicted_monetary", "target_monetary"
    )
    return _rounded(_rounded(report, 2, "rmse", "mse", "mae"), 6, "r2")


# Exploration


@query
def explore_day_number(spark: SparkSession, folder: str) -> DataFrame:
    return explore.day_number(_all_lines(spark, folder), _lines(spark, folder))


@query
def explore_sample(spark: SparkSession, folder: str) -> DataFrame:
    return explore.sample(explore_day_number(spark, folder))


@query
def explore_threshold_date(spark: SparkSession, folder: str) -> DataFrame:
    return explore.threshold_moment(_lines(spark, folder))


@query
def explore_threshold_share(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(explore.share_before(_lines(spark, folder)), 6, "share_before")


@query
def explore_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return explore.frequency(_cleaned(spark, folder))


@query
def explore_recency(spark: SparkSession, folder: str) -> DataFrame:
    return explore.recency(_cleaned(spark, folder))


@query
def explore_monetary(spark: SparkSession, folder: str) -> DataFrame:
    return explore.monetary(_cleaned(spark, folder))


@query
def explore_head(spark: SparkSession, folder: str) -> DataFrame:
    return explore.head(explore_monetary(spark, folder))


def _profile(df: DataFrame, column: str) -> DataFrame:
    return _rounded(
        profile.describe(df, column), 6, "mean", "std", "min", "p25", "p50", "p75", "max"
    )


@query
def profile_monetary(spark: SparkSession, folder: str) -> DataFrame:
    return _profile(explore_monetary(spark, folder), "monetary")


@query
def profile_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return _profile(explore_frequency(spark, folder), "num_transactions")


@query
def profile_recency(spark: SparkSession, folder: str) -> DataFrame:
    return _profile(explore_recency(spark, folder), "recency")


@query
def profile_sample(spark: SparkSession, folder: str) -> DataFrame:
    """Summary of the numeric columns of the sampled lines."""
    names = ["day_number", "Quantity", "UnitPrice"]
    table = profile.describe_columns(explore_sample(spark, folder), names)
    return _rounded(table, 6, "mean", "std", "min", "p25", "p50", "p75", "max")


@query
def profile_sketched(spark: SparkSession, folder: str) -> DataFrame:
    """Profile of all used columns from sketches of two batches, and whether quartiles are as near
    as they should be."""
    rows, names = settle(_features(spark, folder)), [*schemas.used_columns(), schemas.TARGET]
    half = hashing.hash_bucket(F.col("customer_id"), 2) == 0
    parts = profile.sketches(rows.where(half), names).unionByName(profile.sketches(rows.where(~half), names))
    described = settle(profile.describe_sketches(profile.merge_sketches(settle(parts))))
    near = profile.rank_errors(rows, described).groupBy("column").agg(
        (F.max("error") <= profile.RANK_ERROR).alias("quartiles_near")
    )
    table = described.join(near, "column", "left").drop("p25", "p50", "p75")
    return _rounded(table, 4, "mean", "min", "max")


@query
def profile_unit_price(spark: SparkSession, folder: str) -> DataFrame:
    prices = transactions_from_star(spark, folder, ("UnitPrice",))
    return _profile(prices, "UnitPrice")


@query
def profile_continuous(spark: SparkSession, folder: str) -> DataFrame:
    """Summary of an unrounded ratio: mean value per article of a day."""
    ratio = F.col("order_value") / F.col("order_qty_articles")
    return _profile(_daily(spark, folder).where("order_qty_articles <> 0").select(ratio.alias("ratio")), "ratio")


@query
def profile_quantity(spark: SparkSession, folder: str) -> DataFrame:
    """Summary of all quantities."""
    return _profile(transactions_from_star(spark, folder, ("Quantity",)), "Quantity")


@query
def monetary_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return profile.histogram(explore_monetary(spark, folder), "monetary", -1000, 15000, 500)


@query
def monetary_density(spark: SparkSession, folder: str) -> DataFrame:
    """Density of money at 33 points, per million."""
    curve = profile.density(explore_monetary(spark, folder), "monetary", -1000, 15000, 50, 33)
    return curve.withColumn("density", round_half_away(F.col("density") * 1e6, 6))


# Model inputs


@query
def training_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return featurize.training_matrix(_features(spark, folder))


@query
def feat_vocab(spark: SparkSession, folder: str) -> DataFrame:
    index = featurize.vocabulary_index(
        F.col("has_returned"), featurize.VOCABULARIES["has_returned"]
    )
    outside = featurize.vocabulary_index(F.col("cnt_returns"), (0, 2))
    return _features(spark, folder).select(
        "customer_id", index.alias("returned_index"), outside.alias("returns_index")
    )


@query
def feat_category(spark: SparkSession, folder: str) -> DataFrame:
    rows = _features(spark, folder).select("customer_id", "cnt_returns")
    return featurize.as_category(rows, "cnt_returns", "returns_category")


@query
def feat_onehot(spark: SparkSession, folder: str) -> DataFrame:
    hot = featurize.one_hot("cnt_returns", (0, 1))
    return _features(spark, folder).select(
        "customer_id", *[column.alias(name) for name, column in hot.items()]
    )


@query
def feat_bucketized(spark: SparkSession, folder: str) -> DataFrame:
    rows = _features(spark, folder).select("customer_id", "recency")
    return featurize.bucketize(rows, "recency", list(RECENCY_CUTS), "recency_bin")


@query
def feat_identity(spark: SparkSession, folder: str) -> DataFrame:
    index = featurize.identity_index(F.col("frequency_dnn"), 10)
    return _features(spark, folder).select("customer_id", index.alias("frequency_index"))


@query
def feat_crossed(spark: SparkSession, folder: str) -> DataFrame:
    return featurize.crossed(_features(spark, folder), CROSS, "crossed").select(
        "customer_id", "crossed"
    )


@query
def feat_cross_dim(spark: SparkSession, folder: str) -> DataFrame:
    """Slot of each cross in its dense form."""
    width = F.lit(featurize.cross_dimension(CROSS)).cast("bigint")
    rows = featurize.crossed(_features(spark, folder), CROSS, "slot", dense=True)
    return rows.select("customer_id", "slot", width.alias("width"))


# Regression models


def _report(spark: SparkSession, folder: str, model_type: str) -> DataFrame:
    labelled = _labelled(spark, folder)
    model = models.fit_model(model_type, labelled.where("split = 'train'"))
    return models.evaluate_splits(model, labelled)


@query
def regression_line(spark: SparkSession, folder: str) -> DataFrame:
    """Least squares of the target on one feature, over the training rows."""
    y, x = F.col("target_monetary"), F.col("monetary_dnn")
    line = split_train(spark, folder).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept")
    )
    return _rounded(line, 6, "slope", "intercept")


def _moments(spark: SparkSession, folder: str) -> dict[str, ridge.Products]:
    """Products of all splits, from a state to which the splits were added as two batches."""
    labelled = _labelled(spark, folder)
    inputs, path = schemas.used_columns(), scratch_path(spark, "moments")
    halves = F.pmod(F.xxhash64("customer_id"), F.lit(2))
    for batch in (0, 1, 1):  # a batch that is added again replaces itself
        part = moments.moments(labelled.where(halves == batch), inputs, schemas.TARGET)
        moments.add_batch(part, path, str(batch))
    return ridge.products(moments.read_state(spark, path), inputs, schemas.TARGET)


@query
def fit_linear(spark: SparkSession, folder: str) -> DataFrame:
    """Least squares from stored moments: coefficients, and effects of a standard deviation."""
    found = _moments(spark, folder)
    if "train" not in found:
        return spark.createDataFrame([], "term string, coefficient double, effect double")
    (model,) = found["train"].ridge([0.0])
    rows = [("intercept", model.intercept, 0.0), *zip(model.names, model.coefficients.tolist(), model.effects.tolist())]
    table = spark.createDataFrame(rows, "term string, coefficient double, effect double")
    return _rounded(_rounded(table, 2, "coefficient"), 1, "effect")


@query
def fit_linear_report(spark: SparkSession, folder: str) -> DataFrame:
    """Least squares by MLlib: errors on the held-out splits, and its terms."""
    labelled = _labelled(spark, folder)
    model = models.fit_model(models.LEAST_SQUARES, labelled.where("split = 'train'"))
    terms = [f"{value!r} AS {name}" for name, value in models.linear_terms(model)]
    return models.evaluate_splits(model, labelled).selectExpr("*", *terms)


@query
def fit_linear_normal(spark: SparkSession, folder: str) -> DataFrame:
    """Normal equations of least squares: mean of input times label, and times fitted value.

    The two are equal for every input exactly if the fit is the least-squares one.
    """
    train = settle(_labelled(spark, folder).where("split = 'train'"))
    model = models.fit_model(models.LEAST_SQUARES, train)
    fitted = models.score(model, train).select("customer_id", models.PREDICTION)
    names = schemas.used_columns()
    inputs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("input"), F.col(c).cast("double").alias("x")) for c in names])
    )
    rows = train.join(fitted, "customer_id").select("target_monetary", models.PREDICTION, inputs.alias("i"))
    x = F.col("i.x") / 10  # in tens, so that the solver's last digits do not show
    table = rows.groupBy(F.col("i.input").alias("input")).agg(
        F.avg(x * F.col("target_monetary")).alias("by_label"),
        F.avg(x * F.col(models.PREDICTION)).alias("by_fit"),
    )
    return _rounded(table, 0, "by_label", "by_fit")


@query
def fit_linear_wide(spark: SparkSession, folder: str) -> DataFrame:
    labelled = _labelled(spark, folder)
    model = models.fit_model(models.WIDE, labelled.where("split = 'train'"))
    return _rounded(models.score(model, labelled), 2, models.PREDICTION)


@query
def fit_proximal(spark: SparkSession, folder: str) -> DataFrame:
    """Wide model by decayed proximal steps at a small penalty: what it predicts for each value."""
    hot = featurize.one_hot("has_returned", featurize.VOCABULARIES["has_returned"])
    rows = _labelled(spark, folder).withColumns(hot)
    table = moments.moments(rows, list(hot), schemas.TARGET)
    found = ridge.products(table, list(hot), schemas.TARGET)
    if "train" not in found:
        return spark.createDataFrame([], "customer_id string, predicted_monetary double")
    train = found["train"]
    model = ridge.proximal(train, [train], l1=1e-9, decay_rate=0.999, steps=5000)
    value = F.lit(model.intercept)
    for name, coefficient in zip(model.names, model.coefficients.tolist()):
        value = value + F.col(name) * coefficient
    return _rounded(rows.select("customer_id", value.alias("predicted_monetary")), 1, "predicted_monetary")


@query
def tune_proximal(spark: SparkSession, folder: str) -> DataFrame:
    """A hundred settings of the steps, the decay of their rate among them."""
    found = _moments(spark, folder)
    return ridge.step_search(spark, found["train"], [found["train"]], found["eval"])[1]


@query
def fit_linear_crossed(spark: SparkSession, folder: str) -> DataFrame:
    """Wide model with one crossed column."""
    labelled = _labelled(spark, folder)
    options = models.FitOptions(l2=0.01)
    model = models.fit_model(
        models.WIDE, labelled.where("split = 'train'"), options, crosses=(CROSS,)
    )
    return models.evaluate_splits(model, labelled)


@query
def fit_nonlinear(spark: SparkSession, folder: str) -> DataFrame:
    return _report(spark, folder, "dnn_model")


@query
def fit_factorization(spark: SparkSession, folder: str) -> DataFrame:
    return _report(spark, folder, models.FACTORIZATION)


@query
def fit_gbt_mae(spark: SparkSession, folder: str) -> DataFrame:
    """Trees with absolute loss, on chosen inputs and at the settings with the least error of a
    hundred that were halved from rung to rung."""
    labelled = _labelled(spark, folder)
    train = labelled.where("split = 'train'")
    inputs = choose.choose(train, schemas.used_columns(), schemas.TARGET)
    data = boost.binned(labelled, inputs, schemas.TARGET)
    best, rungs = boost.halving(data, boost.draw(boost.TRIALS), metric="mae")
    options = models.FitOptions(
        step_size=best.step_size, max_depth=best.max_depth, min_instances=best.min_instances, columns=tuple(inputs)
    )
    model = models.fit_model(models.ABSOLUTE_ERROR, train, options)
    least = rungs.agg(F.min("error")).scalar().alias("least_trial_mae")
    return models.evaluate_splits(model, labelled).select("*", least)


def _binned(spark: SparkSession, folder: str) -> boost.Binned:
    return boost.binned(_labelled(spark, folder), schemas.used_columns(), schemas.TARGET)


#: One split, half of which is taken.
STUMP = {"step_size": 0.5, "max_depth": 1, "min_instances": 5, "l2": 1.0}


@query
def boost_root(spark: SparkSession, folder: str) -> DataFrame:
    """First split of a boosted tree."""
    data, trial = _binned(spark, folder), boost.Trial(0, **STUMP)
    trial.trees.append(boost._new_tree(1))
    best = boost.best_splits(data, [trial]).select("best.*").where("feature is not null")
    name = F.element_at(F.array(*(F.lit(c) for c in data.inputs)), (F.col("feature") + 1).cast("int"))
    sides = [(F.col(f"{s}_total") / F.col(f"{s}_n")).alias(f"{s}_mean") for s in ("left", "right")]
    return _rounded(best.select(name.alias("input"), "bin", "left_n", "right_n", *sides), 2, "left_mean", "right_mean")


@query
def boost_curve(spark: SparkSession, folder: str) -> DataFrame:
    """Errors of every split before and after the first round, from one pass."""
    data, trial = _binned(spark, folder), boost.Trial(0, **STUMP)
    boost.grow(data, [trial], 1)
    return _rounded(boost.curve(data, [trial]).drop("trial"), 2, "rmse", "mae")


@query
def boost_rungs(spark: SparkSession, folder: str) -> DataFrame:
    """Rungs of a search of a hundred settings: how many go on, and whether they beat the mean."""
    data = _binned(spark, folder)
    _, table = boost.halving(data, boost.draw(boost.TRIALS))
    rungs = table.groupBy("rung", "rounds").agg(
        F.count("*").alias("trials"),
        F.sum(F.col("stays").cast("int")).alias("stay"),
        F.count_distinct("trial").alias("different"),
        F.min("error").alias("least"),
    )
    (mean,) = boost.curve(data, [boost.Trial(0, **STUMP)]).where("split = 'eval'").collect()
    rows = rungs.select(
        *("rung", "rounds", "trials", "stay", "different"),
        (F.col("least") < mean["rmse"]).alias("better"),
        F.lit(mean["rmse"]).alias("rmse_of_mean"),
    )
    return _rounded(rows, 2, "rmse_of_mean")


@query
def boost_stopped(spark: SparkSession, folder: str) -> DataFrame:
    """A saved fit that is continued and stopped at its best round: its error against the curve's."""
    data, path = _binned(spark, folder), scratch_path(spark, "boosting")
    start = [boost.Trial(0, step_size=0.3, max_depth=2, min_instances=5, l2=1.0)]
    boost.grow_saved(data, start, 2, path)
    (trial,) = boost.grow_saved(data, start, 4, path)
    stopped = boost.stopped_early(data, trial)
    errors = boost.predict(data, stopped).groupBy("split").agg(metrics.rmse("predicted", "label").alias("rmse"))
    last = boost.curve(data, [stopped]).where(F.col("round") == len(stopped.trees)).select("split", F.col("rmse").alias("on_curve"))
    return errors.join(last, "split").withColumn("rounds", F.lit(len(stopped.trees)))


@query
def feature_information(spark: SparkSession, folder: str) -> DataFrame:
    """Mutual information of all pairs of inputs and label."""
    names = [*schemas.used_columns(), schemas.TARGET]
    counts = choose.joint_counts(split_train(spark, folder), names)
    return _rounded(choose.mutual_information(counts), 6, "information")


@query
def feature_ranking(spark: SparkSession, folder: str) -> DataFrame:
    """Inputs in the order in which they are chosen."""
    inputs = schemas.used_columns()
    counts = choose.joint_counts(split_train(spark, folder), [*inputs, schemas.TARGET])
    order = choose.ranked(choose.mutual_information(counts), inputs, schemas.TARGET)
    rows = [(i, *found) for i, found in enumerate(order, 1)]
    table = spark.createDataFrame(rows, "place int, input string, relevance double, redundancy double, gain double")
    return _rounded(table, 6, "relevance", "redundancy", "gain")


@query
def tune_linear(spark: SparkSession, folder: str) -> DataFrame:
    """A thousand penalties, all from one table of moments."""
    _, trials = ridge.search(spark, _moments(spark, folder))
    trials = _rounded(trials.withColumn("log_l2", F.log10("l2")), 6, "log_l2")
    return _rounded(trials, 2, "train_rmse", "rmse").select("trial", "log_l2", "train_rmse", "rmse")


@query
def trials_table(spark: SparkSession, folder: str) -> DataFrame:
    """Settings and errors of a search as they were saved, and the newest of the saved models."""
    path = scratch_path(spark, "trials")
    _, table = ridge.search(spark, _moments(spark, folder), trials=20)
    sinks.write_parquet(table.coalesce(1), f"{path}/trials")
    labelled = _labelled(spark, folder)
    _, saved = tune.tune(models.WIDE, labelled, {"l2": tune.Choice((0.5,))}, 3, folder=f"{path}/wide")
    newest = sinks.latest_version(spark, f"{path}/wide/models").first()["version"]
    read = spark.read.parquet(f"{path}/trials")
    place = F.row_number().over(Window.orderBy(round_half_away(F.col("rmse"), 6), "trial"))
    read = _rounded(read.withColumns({"place": place, "log_l2": F.log10("l2")}), 6, "log_l2")
    return _rounded(read, 2, "rmse").select(
        "trial", "log_l2", "rmse", "place", F.lit(newest).cast("int").alias("last_model")
    )


@query
def score_serve(spark: SparkSession, folder: str) -> DataFrame:
    """Entities from a model that was fitted, saved, and loaded as the newest version."""
    labelled = _labelled(spark, folder)
    base = scratch_path(spark, "export")
    model = models.fit_model(models.WIDE, labelled.where("split = 'train'"))
    for version in (9, 10):
        models.save_version(model, base, version)
    scored = models.score(models.load_latest(spark, base), labelled)
    path = scratch_path(spark, "predictions")
    rows = _rounded(scored, 2, models.PREDICTION).select("customer_id", models.PREDICTION)
    sinks.write_json(rows, path)
    return serve.good_entities(serve.prediction_lines(readers.read_predictions(spark, path)))


# Repeat-purchase models


def _summary(spark: SparkSession, folder: str) -> DataFrame:
    return btyd.summary(_features(spark, folder))


def _customer() -> list:
    return [F.col(name) for name in btyd.CUSTOMER_COLUMNS]


@query
def btyd_summary(spark: SparkSession, folder: str) -> DataFrame:
    return _summary(spark, folder)


@query
def btyd_actuals(spark: SparkSession, folder: str) -> DataFrame:
    return btyd.actuals(_features(spark, folder))


@query
def predict_horizon(spark: SparkSession, folder: str) -> DataFrame:
    return btyd.horizon(_features(spark, folder), PARAMS)


def _log_likelihood(spark: SparkSession, folder: str, model) -> DataFrame:
    inputs = [F.col(name) for name in model.inputs]
    term = round_half_away(model.log_likelihood(model.point(), *inputs), 6)
    return _summary(spark, folder).select("customer_id", term.alias("log_likelihood"))


@query
def bgnbd_nll(spark: SparkSession, folder: str) -> DataFrame:
    return _log_likelihood(spark, folder, BG_NBD)


@query
def paretonbd_nll(spark: SparkSession, folder: str) -> DataFrame:
    return _log_likelihood(spark, folder, PARETO_NBD)


@query
def gamma_gamma_nll(spark: SparkSession, folder: str) -> DataFrame:
    return _log_likelihood(spark, folder, GAMMA_GAMMA)


def _expected(spark: SparkSession, folder: str, model) -> DataFrame:
    rows = _summary(spark, folder).select(
        "customer_id",
        model.p_alive(*_customer()).alias("p_alive"),
        model.expected_purchases(PARAMS.time_days, *_customer()).alias("expected_purchases"),
    )
    return _rounded(rows, 6, "p_alive", "expected_purchases")


@query
def bgnbd_expected(spark: SparkSession, folder: str) -> DataFrame:
    return _expected(spark, folder, BG_NBD)


@query
def paretonbd_expected(spark: SparkSession, folder: str) -> DataFrame:
    return _expected(spark, folder, PARETO_NBD)


@query
def gamma_gamma_expected(spark: SparkSession, folder: str) -> DataFrame:
    profit = GAMMA_GAMMA.expected_profit(F.col("frequency"), F.col("monetary_value"))
    return _summary(spark, folder).select("customer_id", profit.alias("expected_profit"))


@query
def btyd_clv(spark: SparkSession, folder: str) -> DataFrame:
    value = btyd.customer_lifetime_value(
        BG_NBD, GAMMA_GAMMA, PARAMS.time_months, PARAMS.discount_rate
    )
    rows = _summary(spark, folder).select("customer_id", value.alias("clv"))
    return _rounded(rows, 4, "clv")


@query
def btyd_clv_long(spark: SparkSession, folder: str) -> DataFrame:
    """Lifetime value over ten years."""
    value = btyd.customer_lifetime_value(BG_NBD, GAMMA_GAMMA, 120, PARAMS.discount_rate)
    rows = _summary(spark, folder).select("customer_id", value.alias("clv"))
    return _rounded(rows, 2, "clv")


@query
def btyd_error(spark: SparkSession, folder: str) -> DataFrame:
    rows = btyd.predict_value(_features(spark, folder), PARETO_NBD, GAMMA_GAMMA, PARAMS)
    measured = ("predicted_num_purchases", "predicted_value", "predicted_total", "error")
    return _rounded(rows, 4, *measured)


def _score_equations(rows: DataFrame, found: fit.Fit, observed: dict, penalizer: float) -> DataFrame:
    """Score equations at the fitted point, from a pass of their own over the customers.

    At the maximum the mean score of each parameter, by its logarithm and less its penalty, is
    zero. ``by_fit`` is a mean of the data, ``by_data``, with that score added.
    """
    model = found.model
    inputs = rows.select(*model.inputs, F.lit(1).alias("n"))
    known = model.values()
    sums = fit.Objective(inputs, type(model)).sums([known])
    scores = sums.select(
        F.col("n").cast("bigint").alias("customers"), *((F.col(f"slope_{name}") / F.col("n")).alias(name) for name in known)
    )
    bound = found.scaled
    means = rows.agg(*(F.avg(value).alias(f"by_data_{name}") for name, value in observed.items()))
    cells = [
        F.struct(
            F.lit(name).alias("parameter"),
            F.col(f"by_data_{name}").alias("by_data"),
            (F.col(f"by_data_{name}") + F.col(name) * known[name] - 2 * penalizer * bound[name] ** 2).alias("by_fit"),
        )
        for name in known
    ]
    # One row of numbers on either side.
    table = scores.withColumns({f"by_data_{n}": means.select(f"by_data_{n}").scalar() for n in known})
    return _rounded(table.select("customers", F.inline(F.array(*cells))), 3, "by_data", "by_fit")


def _timed_equations(rows: DataFrame, found: fit.Fit) -> DataFrame:
    purchases, repeated = F.col("frequency"), (F.col("frequency") > 0).cast("double")
    observed = dict(zip(found.model.values(), (purchases, purchases, repeated, repeated)))
    return _score_equations(rows, found, observed, PARAMS.penalizer)


@query
def fit_bgnbd(spark: SparkSession, folder: str) -> DataFrame:
    rows = settle(_summary(spark, folder))
    return _timed_equations(rows, fit.fit_bgnbd(rows, PARAMS))


@query
def fit_paretonbd(spark: SparkSession, folder: str) -> DataFrame:
    rows = settle(_summary(spark, folder))
    return _timed_equations(rows, fit.fit_paretonbd(rows, PARAMS))


@query
def fit_gamma_gamma(spark: SparkSession, folder: str) -> DataFrame:
    rows = settle(_summary(spark, folder).where("frequency > 0"))
    spent = F.col("frequency") * F.col("monetary_value")
    observed = {"p": F.col("frequency"), "q": F.ln(spent), "v": F.col("frequency")}
    return _score_equations(rows, fit.fit_gamma_gamma(rows), observed, 0.0)


@query
def fit_parameters(spark: SparkSession, folder: str) -> DataFrame:
    """Parameters of the three models, their objectives, and how the fits ended."""
    rows = settle(_summary(spark, folder))
    fits = [fit.fit_bgnbd(rows, PARAMS), fit.fit_paretonbd(rows, PARAMS), fit.fit_gamma_gamma(rows)]
    table = [
        (type(f.model).__name__, name, value, f.objective, f.status, f.gradient_norm, f.rounds)
        for f in fits
        for name, value in f.model.values().items()
    ]
    ddl = "model string, parameter string, value double, objective double, status string, gradient_norm double, rounds int"
    return spark.createDataFrame(table, ddl)


@query
def run_btyd(spark: SparkSession, folder: str) -> DataFrame:
    rows = settle(_features(spark, folder))
    run = pipeline.run_btyd(rows, "bgnbd_model", PARAMS)
    return run.predicted.withColumns(
        {"purchases_status": F.lit(run.purchases_status), "spend_status": F.lit(run.spend_status)}
    )
