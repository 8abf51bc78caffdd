"""Regression models on MLlib, saved and loaded as pipelines that read raw feature rows."""

from __future__ import annotations

import dataclasses

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Transformer
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StandardScaler
from pyspark.ml.regression import FMRegressor, GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custvalue.operators import featurize
from custvalue.operators.metrics import evaluation_report
from custvalue.sources import schemas
from custvalue.sources.readers import with_defaults
from custvalue.sources.sinks import keep_latest, latest_version, mark_complete, version_path

PREDICTION = "predicted_monetary"

# Names a run may ask for.
LEAST_SQUARES = "linear_model"
WIDE = "Linear"
NONLINEAR = ("DNNRegressor", "dnn_model")
FACTORIZATION = "fm_model"
ABSOLUTE_ERROR = "gbt_mae"
REGRESSION_TYPES = (LEAST_SQUARES, WIDE, *NONLINEAR, FACTORIZATION, ABSOLUTE_ERROR)
REPEAT_TYPES = ("paretonbd_model", "bgnbd_model")


@dataclasses.dataclass(frozen=True)
class FitOptions:
    """Settings of a regression fit.

    ``l1`` and ``l2`` are the strengths of the two penalties of a linear model;
    ``max_iter`` is 100 for the gradient methods and 20 for the boosted trees
    unless given; ``columns`` are the used columns to fit on, all unless given; the others
    belong to the trees.
    """

    l1: float = 0.0
    l2: float = 0.0
    max_iter: int | None = None
    step_size: float = 0.1
    max_depth: int = 5
    subsampling_rate: float = 1.0
    min_instances: int = 1
    seed: int = 42
    columns: tuple[str, ...] | None = None


def _indicators() -> SQLTransformer:
    """One-hot columns as a stage that is saved with the model."""
    columns = [
        f"CASE WHEN {name} = {v} THEN 1 ELSE 0 END AS {name}_{v}"
        for name, values in featurize.VOCABULARIES.items()
        for v in values
    ]
    return SQLTransformer(statement=f"SELECT *, {', '.join(columns)} FROM __THIS__")


def _cross_stages(
    keys: list[featurize.CrossKey], name: str, dense: bool
) -> list[Transformer]:
    """Indicator vector of a cross's slot; a key out of its range has no slot and no indicator."""
    width = featurize.cross_dimension(keys) if dense else featurize.cross_size(keys)
    slot, place = f"{name}_slot", f"{name}_place"
    # The place after the last slot stands for none; the encoder drops it.
    places = SparkSession.active().range(width + 1).select(F.col("id").cast("double").alias(place))
    return [
        featurize.cross_stage(keys, slot, dense),
        SQLTransformer(
            statement=f"SELECT *, CAST(coalesce({slot}, {width}) AS DOUBLE) AS {place} FROM __THIS__"
        ),
        OneHotEncoder(inputCol=place, outputCol=name, dropLast=True).fit(places),
    ]


def _iterations(options: FitOptions, default: int) -> int:
    return default if options.max_iter is None else options.max_iter


def _linear(options: FitOptions) -> LinearRegression:
    strength = options.l1 + options.l2
    return LinearRegression(
        labelCol=schemas.TARGET,
        predictionCol=PREDICTION,
        maxIter=_iterations(options, 100),
        regParam=strength,
        elasticNetParam=options.l1 / strength if strength else 0.0,
    )


def _trees(options: FitOptions, loss: str) -> GBTRegressor:
    return GBTRegressor(
        labelCol=schemas.TARGET,
        predictionCol=PREDICTION,
        lossType=loss,
        maxIter=_iterations(options, 20),
        stepSize=options.step_size,
        maxDepth=options.max_depth,
        subsamplingRate=options.subsampling_rate,
        minInstancesPerNode=options.min_instances,
        seed=options.seed,
    )


def _factorization(options: FitOptions) -> FMRegressor:
    return FMRegressor(
        featuresCol="scaled_features",
        labelCol="scaled_label",
        predictionCol="scaled_prediction",
        factorSize=4,
        maxIter=_iterations(options, 100),
        stepSize=options.step_size,
        regParam=options.l2,
        seed=options.seed,
    )


def pipeline(
    model_type: str,
    options: FitOptions = FitOptions(),
    crosses: tuple[list[featurize.CrossKey], ...] = (),
    label_scale: float = 1.0,
) -> Pipeline:
    """Unfitted pipeline of a regression type.

    Crosses are hashed to their full size for the wide model, and to their dense
    width for the others; none are used by default.  The factorization machine works on
    standardized inputs and on the label divided by ``label_scale``.
    """
    deep = featurize.deep_columns()
    if model_type == LEAST_SQUARES:
        inputs, regressor = schemas.used_columns(), _linear(options)
    elif model_type == WIDE:
        inputs, regressor = featurize.deep_columns(with_continuous=False), _linear(options)
    elif model_type in NONLINEAR:
        inputs, regressor = deep, _trees(options, "squared")
    elif model_type == ABSOLUTE_ERROR:
        inputs, regressor = deep, _trees(options, "absolute")
    elif model_type == FACTORIZATION:
        inputs, regressor = deep, _factorization(options)
    else:
        raise ValueError(f"model_type must be one of {REGRESSION_TYPES}, got {model_type!r}")
    if options.columns is not None:
        dropped = set(schemas.used_columns()) - set(options.columns)
        one_hot = {f"{c}_{v}": c for c, values in featurize.VOCABULARIES.items() for v in values}
        inputs = [name for name in inputs if one_hot.get(name, name) not in dropped]
    stages: list = [_indicators()]
    for i, keys in enumerate(crosses):
        stages += _cross_stages(keys, f"cross_{i}", dense=model_type != WIDE)
    names = inputs + [f"cross_{i}" for i in range(len(crosses))]
    stages.append(featurize.assembler(names))
    if model_type == FACTORIZATION:
        scaler = StandardScaler(inputCol="features", outputCol="scaled_features", withMean=True)
        back = f"SELECT *, scaled_prediction * {label_scale!r}D AS {PREDICTION} FROM __THIS__"
        return Pipeline(stages=[*stages, scaler, regressor, SQLTransformer(statement=back)])
    return Pipeline(stages=[*stages, regressor])


def fit_model(
    model_type: str,
    train: DataFrame,
    options: FitOptions = FitOptions(),
    crosses: tuple[list[featurize.CrossKey], ...] = (),
) -> PipelineModel:
    """Fit on the used columns of the training rows."""
    rows = train.select(*schemas.used_columns(with_key=True, with_target=True))
    if model_type != FACTORIZATION:
        return pipeline(model_type, options, crosses).fit(rows)
    scale = float(rows.agg(F.stddev(schemas.TARGET)).first()[0] or 1.0)
    labelled = rows.withColumn("scaled_label", F.col(schemas.TARGET) / scale)
    return pipeline(model_type, options, crosses, scale).fit(labelled)


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Key and prediction of each row, empty fields taken as their defaults.

    A label is passed on as it is; an unknown one stays NULL and out of any metric.
    """
    kept = [c for c in ("split", schemas.TARGET) if c in rows.columns]
    label = [F.col(schemas.TARGET).alias("_label")] if schemas.TARGET in kept else []
    filled = with_defaults(rows.select("*", *label)).drop(schemas.TARGET)
    filled = filled.withColumnRenamed("_label", schemas.TARGET)
    return model.transform(filled).select(schemas.KEY, *kept, PREDICTION)


def evaluate_splits(model: PipelineModel, labelled: DataFrame) -> DataFrame:
    """Metrics on the evaluation and test rows, in one pass."""
    held_out = labelled.where(F.col("split").isin("eval", "test"))
    return evaluation_report(score(model, held_out), PREDICTION, schemas.TARGET, by=["split"])


def linear_terms(model: PipelineModel) -> list[tuple[str, float]]:
    """Intercept and coefficients of a fitted linear model by input name."""
    assembler, regression = model.stages[-2:]
    return [
        ("intercept", float(regression.intercept)),
        *zip(assembler.getInputCols(), map(float, regression.coefficients)),
    ]


def save_version(model: PipelineModel, base: str, version: int, keep: int | None = None) -> str:
    """Save under ``base`` as a version, replacing that version if it exists.

    With ``keep`` only so many versions, the largest, stay.
    """
    path = version_path(base, version)
    model.write().overwrite().save(path)
    mark_complete(SparkSession.active(), path)
    if keep is not None:
        keep_latest(SparkSession.active(), base, keep)
    return path


def load_latest(spark: SparkSession, base: str) -> PipelineModel:
    """Load the numerically largest version under ``base``."""
    version = latest_version(spark, base).first()[0]
    if version is None:
        raise FileNotFoundError(f"no version under {base}")
    return PipelineModel.load(version_path(base, version))


def has_version(spark: SparkSession, base: str) -> bool:
    """Whether a version was saved under ``base``."""
    return latest_version(spark, base).first()[0] is not None


def fit_or_resume(
    model_type: str,
    train: DataFrame,
    base: str,
    version: int,
    options: FitOptions = FitOptions(),
    resume: bool = False,
) -> PipelineModel:
    """Load the latest version if resuming and there is one; otherwise fit and save."""
    if resume and has_version(train.sparkSession, base):
        return load_latest(train.sparkSession, base)
    model = fit_model(model_type, train, options)
    save_version(model, base, version, keep=1)
    return model
