"""Moments of inputs and label: sums of products from one pass, which merge by addition.

A table of moments has a row for each pair of columns of each group: ``left``, ``right`` and
``total``, the sum of their products. ``ONE`` stands for a column of ones, so it also holds the
counts and the sums. Every linear fit, at any penalty, and its squared error on any group follow
from the table; rows are not read again.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ONE = "1"


def moments(rows: DataFrame, inputs: Iterable[str], label: str, by: str = "split") -> DataFrame:
    """Moments of each group; rows with a null input or label are left out."""
    names = [ONE, *inputs, label]
    columns = [F.lit(1.0), *(F.col(c).cast("double") for c in names[1:])]
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    sums = [F.sum(columns[i] * columns[j]).alias(f"m{i}_{j}") for i, j in pairs]
    table = rows.dropna(subset=names[1:]).groupBy(by).agg(*sums)
    cells = [
        F.struct(F.lit(names[i]).alias("left"), F.lit(names[j]).alias("right"), F.col(f"m{i}_{j}").alias("total"))
        for i, j in pairs
    ]
    return table.select(by, F.inline(F.array(*cells)))


def merge(parts: DataFrame, by: str = "split") -> DataFrame:
    """Moments of all rows from those of disjoint parts of them."""
    return parts.groupBy(by, "left", "right").agg(F.sum("total").alias("total"))


def add_batch(part: DataFrame, path: str, batch: str) -> None:
    """Put the moments of a batch of rows into a state; a batch that is there is replaced."""
    writer = part.withColumn("batch", F.lit(batch)).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)


def read_state(spark: SparkSession, path: str, by: str = "split") -> DataFrame:
    """Moments of all batches of a state."""
    return merge(spark.read.parquet(path), by)
