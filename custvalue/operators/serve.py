"""Prediction records to serving entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custvalue.sources import schemas

# Fixed value of the serving records.
ENTITY_KIND = "clv"
CORRUPT = "_corrupt_record"
LINE_SCHEMA = T.StructType(
    [f for f in schemas.PREDICTIONS.fields if f.name != "predictions"]
    + [T.StructField(CORRUPT, T.StringType())]
)


def prediction_lines(scored: DataFrame) -> DataFrame:
    """One JSON text per prediction."""
    record = F.struct("customer_id", "predicted_monetary")
    return scored.select(F.to_json(record).alias("value"))


def entity(customer_id: Column, predicted: Column) -> Column:
    """Entity JSON of one prediction; absent fields stay absent."""
    path = F.struct(F.lit(ENTITY_KIND).alias("kind"), customer_id.alias("name"))
    return F.to_json(
        F.struct(
            F.struct(F.array(path).alias("path")).alias("key"),
            F.struct(F.struct(predicted.alias("doubleValue")).alias("predicted_monetary")).alias(
                "properties"
            ),
        )
    )


def entities(lines: DataFrame) -> DataFrame:
    """Each prediction line with its entity JSON, or NULL if the line is no prediction object.

    Row-wise: parse, and rebuild, with no function call outside the plan.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = lines.select(
        F.col("value").alias("line"), F.from_json("value", LINE_SCHEMA, options).alias("p")
    )
    is_object = F.col("p").isNotNull() & F.col(f"p.{CORRUPT}").isNull() & (
        F.substring(F.ltrim("line"), 1, 1) == "{"
    )
    record = entity(F.col("p.customer_id"), F.col("p.predicted_monetary"))
    return parsed.select("line", F.when(is_object, record).alias("entity"))


def good_entities(lines: DataFrame) -> DataFrame:
    """Entities to load."""
    return entities(lines).where(F.col("entity").isNotNull()).select("entity")


def entity_errors(lines: DataFrame) -> DataFrame:
    """Lines for the error output."""
    return entities(lines).where(F.col("entity").isNull()).select("line")
