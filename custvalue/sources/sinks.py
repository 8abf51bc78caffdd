"""Writers: tables, CSV, NDJSON, and versioned folders."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

# Name of the file that a finished write leaves.
MARKER = "_SUCCESS"


def write_table(df: DataFrame, name: str) -> None:
    """Create or replace a catalog table."""
    df.write.mode("overwrite").saveAsTable(name)


def write_parquet(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Replace a Parquet folder, optionally partitioned for pruned reads."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str, header: bool) -> None:
    """Replace a CSV folder."""
    df.write.mode("overwrite").option("header", header).option("escape", '"').csv(path)


def write_splits(labelled: DataFrame, folder: str) -> None:
    """Headerless CSV folders ``train.csv``, ``eval.csv`` and ``test.csv``.

    ``labelled`` carries a ``split`` column.  Store it (or cache it) first when
    its plan is costly: each split is one filtered write.
    """
    for split in ("train", "eval", "test"):
        part = labelled.where(F.col("split") == split).drop("split")
        write_csv(part, f"{folder.rstrip('/')}/{split}.csv", header=False)


def write_json(df: DataFrame, path: str) -> None:
    """Replace an NDJSON folder, one shard per partition."""
    df.write.mode("overwrite").json(path)


def write_lines(df: DataFrame, path: str) -> None:
    """Replace a text folder from a one-column DataFrame."""
    df.write.mode("overwrite").text(path)


def send_rows(df: DataFrame, writer: Callable[[Iterable[Row]], None]) -> None:
    """Hand each partition to a caller's writer, for stores Spark has no format for.

    A task may run again after an executor is lost, so the writer must upsert.
    """
    df.foreachPartition(writer)


def version_path(base: str, version: int) -> str:
    """Folder of one exported version."""
    return f"{base.rstrip('/')}/version={version}"


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def mark_complete(spark: SparkSession, path: str) -> None:
    """Leave the marker of a finished write in a folder."""
    marker, files = _file_system(spark, f"{path}/{MARKER}")
    files.create(marker, True).close()


def finished_versions(spark: SparkSession, base: str) -> list[int]:
    """Numbers of the finished ``version=<n>`` folders right under ``base``, smallest first.

    A version is finished if it, or the write of all of them, left its marker.
    """
    folder, files = _file_system(spark, base)
    found = files.listStatus(folder) if files.exists(folder) else []
    all_done = files.exists(_file_system(spark, f"{base}/{MARKER}")[0])
    numbers = []
    for status in found:
        match = re.fullmatch(r"version=(\d+)", status.getPath().getName())
        if match and status.isDirectory():
            own = _file_system(spark, f"{version_path(base, match[1])}/{MARKER}")[0]
            if all_done or files.exists(own):
                numbers.append(int(match[1]))
    return sorted(numbers)


def keep_latest(spark: SparkSession, base: str, count: int = 1) -> None:
    """Remove all finished versions but the numerically largest; unfinished ones stay."""
    for number in finished_versions(spark, base)[:-count]:
        path, files = _file_system(spark, version_path(base, number))
        files.delete(path, True)


def latest_version(spark: SparkSession, base: str) -> DataFrame:
    """One row with the numerically largest finished version right under ``base``."""
    numbers = finished_versions(spark, base)
    return spark.createDataFrame([(max(numbers, default=None),)], "version bigint")
