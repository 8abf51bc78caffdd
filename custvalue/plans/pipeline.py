"""End-to-end runs: build from raw lines, and predict and serve from new rows."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from custvalue.operators import btyd, clean, features, serve, split
from custvalue.operators.metrics import evaluation_report, rmse
from custvalue.params import ClvParams
from custvalue.plans import fit, models
from custvalue.sources import readers, sinks


class BtydRun(NamedTuple):
    """Predictions per customer, their RMSE, and how the fits of the two models ended."""

    predicted: DataFrame
    rmse: float | None
    purchases_status: str
    spend_status: str


def run_btyd(feature_rows: DataFrame, model_type: str, params: ClvParams) -> BtydRun:
    """Fit a repeat-purchase model and the spend model, and predict with them."""
    fitters = dict(zip(models.REPEAT_TYPES, (fit.fit_paretonbd, fit.fit_bgnbd)))
    if model_type not in fitters:
        raise ValueError(f"model_type must be one of {models.REPEAT_TYPES}, got {model_type!r}")
    summary = btyd.summary(feature_rows)
    purchases, spend = fitters[model_type](summary, params), fit.fit_gamma_gamma(summary)
    predicted = btyd.predict_value(feature_rows, purchases.model, spend.model, params)
    error = predicted.agg(rmse("predicted_total", "actual_total")).first()[0]
    return BtydRun(predicted, error, purchases.status, spend.status)


def build(
    source: DataFrame,
    params: ClvParams,
    folder: str,
    model_type: str,
    version: int = 1,
    options: models.FitOptions = models.FitOptions(),
    resume: bool = False,
) -> DataFrame:
    """Clean, make features, split, export, fit and report.

    Each stage is written under ``folder`` and the next one reads the written
    table.  Returns the metrics.
    """
    spark = source.sparkSession
    root = folder.rstrip("/")

    def stage(df: DataFrame, name: str) -> DataFrame:
        sinks.write_parquet(df, f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")

    cleaned = stage(clean.clean_orders(source, params), "data_cleaned")
    rows = stage(features.features_n_target(cleaned, params), "features_n_target")
    if model_type in models.REPEAT_TYPES:
        sinks.write_csv(rows, f"{root}/btyd.csv", header=True)
        predicted = run_btyd(rows, model_type, params).predicted
        sinks.write_csv(predicted, f"{root}/predictions.csv", header=True)
        written = readers.read_csv(spark, f"{root}/predictions.csv", predicted.schema)
        return evaluation_report(written, "predicted_total", "actual_total")
    sinks.write_parquet(split.with_split(rows, params), f"{root}/splits", partition_by="split")
    labelled = spark.read.parquet(f"{root}/splits")
    if model_type != models.ABSOLUTE_ERROR:
        sinks.write_splits(labelled, root)
    model = models.fit_or_resume(
        model_type,
        labelled.where("split = 'train'"),
        f"{root}/export",
        version,
        options,
        resume,
    )
    return models.evaluate_splits(model, labelled)


def predict_serve(
    spark: SparkSession,
    model: PipelineModel,
    scoring: DataFrame,
    folder: str,
    table: str | None = None,
) -> DataFrame:
    """Score new rows; write JSON shards, the prediction table, entities and errors.

    Everything after scoring reads the written shards.  Returns the predictions.
    """
    root = folder.rstrip("/")
    shards = f"{root}/output"
    sinks.write_json(models.score(model, scoring), shards)
    predictions = readers.read_predictions(spark, shards)
    if table:
        sinks.write_table(predictions, table)
    else:
        sinks.write_parquet(predictions, f"{root}/predictions")
    lines = spark.read.text(shards)
    sinks.write_lines(serve.good_entities(lines), f"{root}/entities")
    sinks.write_lines(serve.entity_errors(lines), f"{root}/errors")
    return predictions
