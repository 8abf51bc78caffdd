"""What several corpus operators share: tables, words, the shared folder."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from custvalue.functions.scratch import scratch_path

#: The white space of word rules: space and the control characters 9 to 13.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the corpus folder; Spark opens it, so any store works."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the written table.

    Cuts lineage and makes later passes read the same rows whatever is lost; unlike a
    cached table it survives the executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(column: str | Column) -> Column:
    """The text, a null one as the empty text."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column, F.lit(""))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores as needed to differ from all columns of ``df``."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name)
        found.append(name)
    return found


def word_count(text: Column) -> Column:
    """Number of maximal runs without white space, without building a list of them."""
    dots = F.regexp_replace(text, f"[^{SPACE}]+", "x")
    return F.length(F.regexp_replace(dots, f"[{SPACE}]+", "")).cast("long")


#: Texts that cross between Spark and a Python worker together, at most.
BATCH_ROWS = 1000


def ship(spark: SparkSession) -> None:
    """Prepare the session for Python workers that read texts.

    Sends this package to them, once, and lowers the rows of an Arrow batch: both sides hold
    whole batches, and ten thousand long texts are too much for either.
    """
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    context = spark.sparkContext
    if getattr(context, "_custvalue_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    # Spark copies the file when it is added; the folder goes with the driver's process.
    context._custvalue_folder = tempfile.TemporaryDirectory(prefix="custvalue-", ignore_cleanup_errors=True)
    package = os.path.join(context._custvalue_folder.name, "custvalue_package.zip")
    with zipfile.ZipFile(package, "w") as out:
        for folder, _, names in os.walk(os.path.join(root, "custvalue")):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, root))
    context.addPyFile(package)
    context._custvalue_shipped = True
