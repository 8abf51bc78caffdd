"""Scans: CSV, NDJSON and catalog tables, always with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custvalue.sources import schemas

SPLITS = ("train", "eval", "test")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by (possibly qualified) name."""
    return spark.sql("SELECT * FROM IDENTIFIER(:name)", args={"name": name})


def query(spark: SparkSession, sql: str, **args: object) -> DataFrame:
    """SQL text with named parameter markers."""
    return spark.sql(sql, args=args)


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    header: bool = True,
    check_header: bool = True,
) -> DataFrame:
    """CSV with the given schema; empty fields are NULL.

    A malformed row stops the job, and so does a header with other names than the schema,
    unless it is not to be checked: then the first line of a file is passed over as it is.
    """
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("enforceSchema", not (header and check_header))
        .option("nullValue", "")
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_transactions(
    spark: SparkSession, path: str | list[str], check_header: bool = True
) -> DataFrame:
    """Raw order lines with one header row per file, whose names may be left unchecked."""
    return read_csv(spark, path, schemas.TRANSACTIONS, check_header=check_header)


def read_features(spark: SparkSession, path: str | list[str], header: bool = True) -> DataFrame:
    """Feature rows as exported with a header for the repeat-purchase models."""
    return read_csv(spark, path, schemas.FEATURES, header)


def with_defaults(df: DataFrame) -> DataFrame:
    """Replace NULLs of known feature columns by their file default."""
    return df.fillna({c: v for c, v in schemas.DEFAULTS.items() if c in df.columns})


def read_split(spark: SparkSession, folder: str, split: str) -> DataFrame:
    """Headerless feature files of one split: every ``<split>*.csv`` under the folder."""
    if split not in SPLITS:
        raise ValueError(f"split must be one of {SPLITS}, got {split!r}")
    return read_csv(spark, f"{folder.rstrip('/')}/{split}*.csv", schemas.FEATURES, header=False)


def read_scoring(
    spark: SparkSession, path: str | list[str], header: bool = False, fmt: str = "csv"
) -> DataFrame:
    """Rows to score: CSV with or without a header, or NDJSON, in the scoring schema."""
    if fmt == "json":
        rows = spark.read.schema(schemas.SCORING).option("mode", "FAILFAST").json(path)
    elif fmt == "csv":
        rows = read_csv(spark, path, schemas.SCORING, header)
    else:
        raise ValueError(f"fmt must be 'csv' or 'json', got {fmt!r}")
    return with_defaults(rows)


def read_predictions(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Prediction records from NDJSON shards; every line is a record."""
    return spark.read.schema(schemas.PREDICTIONS).option("mode", "FAILFAST").json(path)


def shard_names(df: DataFrame) -> DataFrame:
    """The distinct files a file-based DataFrame was read from."""
    return df.select(F.col("_metadata.file_path").alias("file_path")).distinct()


def column_specs(df: DataFrame) -> dict[str, str]:
    """Column name to type name."""
    return dict(df.dtypes)
