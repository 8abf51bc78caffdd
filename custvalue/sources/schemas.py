"""Declared schemas.  Column orders and defaults are fixed values of the file formats."""

from __future__ import annotations

from pyspark.sql import types as T

TRANSACTIONS = T.StructType(
    [
        T.StructField("InvoiceNo", T.StringType()),
        T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("Quantity", T.LongType()),
        T.StructField("InvoiceDate", T.StringType()),
        T.StructField("UnitPrice", T.DoubleType()),
        T.StructField("CustomerID", T.StringType()),
        T.StructField("Country", T.StringType()),
    ]
)

FEATURES = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("monetary_dnn", T.DoubleType()),
        T.StructField("monetary_btyd", T.DoubleType()),
        T.StructField("frequency_dnn", T.LongType()),
        T.StructField("frequency_btyd", T.LongType()),
        T.StructField("recency", T.LongType()),
        T.StructField("T", T.LongType()),
        T.StructField("time_between", T.DoubleType()),
        T.StructField("avg_basket_value", T.DoubleType()),
        T.StructField("avg_basket_size", T.DoubleType()),
        T.StructField("cnt_returns", T.LongType()),
        T.StructField("has_returned", T.IntegerType()),
        T.StructField("frequency_btyd_clipped", T.LongType()),
        T.StructField("monetary_btyd_clipped", T.DoubleType()),
        T.StructField("target_monetary_clipped", T.DoubleType()),
        T.StructField("target_monetary", T.DoubleType()),
    ]
)

KEY = "customer_id"
TARGET = "target_monetary"

# Columns that no regression model reads.
UNUSED = (
    "customer_id",
    "monetary_btyd",
    "frequency_btyd",
    "frequency_btyd_clipped",
    "monetary_btyd_clipped",
    "target_monetary_clipped",
)

# What an empty field of a feature file means.
DEFAULT_BY_TYPE = {"string": "", "double": 0.0, "bigint": 0, "int": 0}
DEFAULTS = {
    field.name: DEFAULT_BY_TYPE[field.dataType.simpleString()] for field in FEATURES.fields
} | {"has_returned": -1}

SCORING = T.StructType(
    [field for field in FEATURES.fields if field.name == KEY or field.name not in (*UNUSED, TARGET)]
)

PREDICTIONS = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("predicted_monetary", T.DoubleType()),
        T.StructField("predictions", T.DoubleType()),
    ]
)


def used_columns(with_key: bool = False, with_target: bool = False) -> list[str]:
    """Names of the columns a regression model uses, in file order."""
    used = [f.name for f in FEATURES.fields if f.name not in UNUSED and f.name != TARGET]
    return [KEY] * with_key + used + [TARGET] * with_target
