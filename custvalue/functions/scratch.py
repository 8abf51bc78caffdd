"""Shared folder for tables that cut lineage or pass through files."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


@functools.lru_cache(maxsize=1)
def _own_folder() -> tempfile.TemporaryDirectory:
    """A folder of this process, for a local master that names none; it goes with the process."""
    return tempfile.TemporaryDirectory(prefix="custvalue-", ignore_cleanup_errors=True)


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names; one of this process only on a local master."""
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
    return _own_folder().name


def _application_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/custvalue-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder."""
    return f"{_application_dir(spark)}/{label}-{uuid.uuid4().hex}"


def clear(spark: SparkSession) -> None:
    """Remove what this application has left in the shared folder; for its owner, at its end."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_application_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and go on from the written copy.

    Iterative jobs read the result many times, and only the columns they need; a lost executor
    then costs a re-read, not a recomputation of the whole pipeline.
    """
    path = scratch_path(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
