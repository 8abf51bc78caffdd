"""Model inputs from the feature table: numeric, categorical and crossed columns."""

from __future__ import annotations

import dataclasses
import functools
import operator

from pyspark.ml.feature import Bucketizer, SQLTransformer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custvalue.functions.hashing import hash_bucket_sql
from custvalue.operators.order import numbered
from custvalue.sources import schemas

# Numeric model inputs and the categorical one with its vocabulary.
NUMERICS = (
    "monetary_dnn",
    "frequency_dnn",
    "recency",
    "T",
    "time_between",
    "avg_basket_value",
    "avg_basket_size",
    "cnt_returns",
)
VOCABULARIES = {"has_returned": (0, 1)}
MAX_CROSS_BUCKETS = 10000


def vocabulary_index(column: Column, values: tuple) -> Column:
    """Position in the vocabulary; -1 for anything else."""
    places = (F.when(column == v, i) for i, v in enumerate(values))
    return F.coalesce(*places, F.lit(-1))


def one_hot(name: str, values: tuple) -> dict[str, Column]:
    """One 0/1 column per vocabulary value; all zero outside the vocabulary."""
    return {
        f"{name}_{v}": F.when(F.col(name) == v, 1).otherwise(0) for v in values
    }


def as_category(df: DataFrame, name: str, out: str) -> DataFrame:
    """Treat a column as a category, numbered from the most frequent value; ties in text order.

    The values are counted into a dictionary, numbered by ranges of its order and joined back;
    none comes to the driver, and no task sees all of them.  A NULL has no number.
    """
    counted = df.where(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("_n"))
    places = numbered(counted, "_place", F.desc("_n"), F.col(name).cast("string"))
    dictionary = places.select(name, F.col("_place").cast("int").alias(out))
    return df.join(dictionary, name, "left").select(*df.columns, out)


def bucketize(df: DataFrame, name: str, boundaries: list[float], out: str) -> DataFrame:
    """Left-closed bins; the first and last are open-ended."""
    edges = [float("-inf"), *map(float, boundaries), float("inf")]
    binned = Bucketizer(splits=edges, inputCol=name, outputCol=out).transform(df)
    return binned.withColumn(out, F.col(out).cast("int"))


def identity_index(column: Column, buckets: int) -> Column:
    """The value itself where ``0 <= value < buckets``, else NULL."""
    whole = column.cast("bigint")
    return F.when((whole >= 0) & (whole < buckets), whole)


@dataclasses.dataclass(frozen=True)
class CrossKey:
    """One key of a crossed column.

    A numeric key is cut at ``boundaries``, or taken as ``buckets`` known values
    if it has none; a categorical key is taken as it is.
    """

    name: str
    buckets: int
    boundaries: tuple[float, ...] | None = None


def cross_size(keys: list[CrossKey]) -> int:
    """Number of hash buckets of a cross."""
    return min(_cells(keys), MAX_CROSS_BUCKETS)


def cross_dimension(keys: list[CrossKey]) -> int:
    """Width of the dense form of a cross: the fourth root of its cells."""
    return int(_cells(keys) ** 0.25)


def _cells(keys: list[CrossKey]) -> int:
    return functools.reduce(operator.mul, (key.buckets for key in keys), 1)


def _key_sql(key: CrossKey) -> str:
    """Text of one key: its bin, its known value, or the value as it is."""
    if key.name in NUMERICS and key.boundaries is not None:
        bins = "".join(f" WHEN {key.name} < {edge!r}D THEN {i}" for i, edge in enumerate(map(float, key.boundaries)))
        return f"CASE WHEN {key.name} IS NULL THEN NULL{bins} ELSE {len(key.boundaries)} END"
    if key.name in NUMERICS:
        whole = f"CAST({key.name} AS BIGINT)"
        return f"CASE WHEN {whole} >= 0 AND {whole} < {key.buckets} THEN {whole} END"
    return key.name


def cross_stage(keys: list[CrossKey], out: str, dense: bool = False) -> SQLTransformer:
    """Stage that adds the slot of a cross; NULL if a key is out of its range.

    The combined keys are hashed into ``cross_size`` slots, and those into the dense width if
    that is asked for.  Models save this very stage.
    """
    # concat with separators, not concat_ws, so that a missing key gives NULL.
    texts = [f"CAST({_key_sql(key)} AS STRING)" for key in keys]
    slot = hash_bucket_sql(f"concat({', \'_X_\', '.join(texts)})", cross_size(keys))
    if dense:
        slot = hash_bucket_sql(f"CAST({slot} AS STRING)", cross_dimension(keys))
    return SQLTransformer(statement=f"SELECT *, {slot} AS {out} FROM __THIS__")


def crossed(df: DataFrame, keys: list[CrossKey], out: str, dense: bool = False) -> DataFrame:
    """Add the slot of the combined keys."""
    return cross_stage(keys, out, dense).transform(df)


def deep_columns(with_continuous: bool = True) -> list[str]:
    """Names of the dense inputs: indicator columns, then numeric ones."""
    indicators = [f"{name}_{v}" for name, values in VOCABULARIES.items() for v in values]
    return indicators + list(NUMERICS) * with_continuous


def training_matrix(features: DataFrame, with_continuous: bool = True) -> DataFrame:
    """Key, dense model inputs as flat columns, and target; unused columns are gone."""
    kept = features.select(*schemas.used_columns(with_key=True, with_target=True))
    hot = [one_hot(name, values) for name, values in VOCABULARIES.items()]
    return kept.withColumns(functools.reduce(operator.or_, hot, {})).select(
        schemas.KEY, *deep_columns(with_continuous), schemas.TARGET
    )


def input_columns(table: DataFrame) -> list[str]:
    """Columns of a feature table left after the key, the unused ones and the target."""
    return [name for name in table.columns if name not in (*schemas.UNUSED, schemas.TARGET)]


def assembler(inputs: list[str], out: str = "features") -> VectorAssembler:
    """Vector column of the named inputs; a NULL input stops the job."""
    return VectorAssembler(inputCols=inputs, outputCol=out, handleInvalid="error")
