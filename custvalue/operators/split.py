"""Deterministic train / eval / test split by hash of the customer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custvalue.functions.hashing import hash_bucket
from custvalue.params import ClvParams


def with_bucket(df: DataFrame, params: ClvParams, name: str = "bucket") -> DataFrame:
    """Add the hash bucket of ``customer_id``."""
    return df.withColumn(name, hash_bucket(F.col("customer_id"), params.buckets))


def with_split(df: DataFrame, params: ClvParams) -> DataFrame:
    """Add ``split``: train, eval, test, or none for the one bucket between eval and test."""
    bucket = F.col("_bucket")
    label = (
        F.when(bucket <= params.train_hi, "train")
        .when(bucket < params.eval_hi, "eval")
        .when((bucket > params.eval_hi) & (bucket < params.buckets), "test")
        .otherwise("none")
    )
    return with_bucket(df, params, "_bucket").withColumn("split", label).drop("_bucket")


def split_rows(df: DataFrame, params: ClvParams, split: str) -> DataFrame:
    """The rows of one split."""
    return with_split(df, params).where(F.col("split") == split).drop("split")


#: Blocks that rows are shuffled into; part of what makes the order reproducible.
BLOCKS = 200


def shuffled(df: DataFrame, seed: int, blocks: int = BLOCKS) -> DataFrame:
    """Rows in a reproducible random order.

    A seeded hash of the customer deals the rows into blocks and orders each block, so no
    boundaries are looked for and nothing is sorted beyond a block. The order is that of the
    blocks one after the other; it depends on the seed and on their number alone.
    """
    key = F.xxhash64(F.col("customer_id"), F.lit(seed))
    return df.repartition(blocks, key).sortWithinPartitions(key, "customer_id")
