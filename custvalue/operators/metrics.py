"""Regression metrics as one aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _error(prediction: str, label: str) -> Column:
    return F.col(prediction) - F.col(label)


def mse(prediction: str, label: str) -> Column:
    return F.avg(F.pow(_error(prediction, label), 2))


def rmse(prediction: str, label: str) -> Column:
    """Root mean squared error; NULL on no rows."""
    return F.sqrt(mse(prediction, label))


def mae(prediction: str, label: str) -> Column:
    return F.avg(F.abs(_error(prediction, label)))


def r2(prediction: str, label: str) -> Column:
    """Share of variance explained; NULL if the label does not vary."""
    return 1.0 - F.try_divide(mse(prediction, label), F.var_pop(label))


def evaluation_report(
    scored: DataFrame, prediction: str, label: str, by: list[str] | None = None
) -> DataFrame:
    """Row count, RMSE, MSE, MAE and R2, overall or per group, of the rows with a known label."""
    return scored.where(F.col(label).isNotNull()).groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("n"),
        rmse(prediction, label).alias("rmse"),
        mse(prediction, label).alias("mse"),
        mae(prediction, label).alias("mae"),
        r2(prediction, label).alias("r2"),
    )
