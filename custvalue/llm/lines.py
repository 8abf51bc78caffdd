"""Line dedup by levelled sorted runs of line hashes.

Every batch of documents brings the hashes of its lines, one row each, with the number of its
documents that hold the line. The batch is merged against the sorted runs of the batches before:
a hash that none of them has is new and takes its keeper from this batch, any other adds to the
count only. What the batch brought becomes a run of the lowest level; a level that is full is
compacted into one run of the next. Runs are bucketed by hash and sorted in the buckets, so a
merge moves the rows of the batch alone.

Batches are ranges of doc_id, the largest first, so the batch that brings a line first holds its
largest doc_id. Their number is a parameter and does not follow the input.

A line's key is the line without white space at both ends, A-Z in lower case; its hash has 128
bits. Rows of a line that very many documents hold are counted before they are shuffled, and
the join that hands verdicts back has one row for each line on the other side.

Defined cases: a null or empty text is one empty line; every row counts as a document, also where
doc_id is repeated or null; all rows that have the largest doc_id keep their lines, and a null
doc_id is the largest only where no other has the line; lines that repeat within a document
stay or go together; very long texts are split into lines within their row; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from custvalue.functions.scratch import scratch_path
from custvalue.llm.common import settle, ship, text_of

BLANKS = " \t\n\x0b\x0c\r"
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Code points of the shortest key that is looked at, and documents from which a line goes.
SHORTEST, HOLDERS = 40, 5
#: Batches of a whole table, and runs of a level that are compacted into one.
BATCHES, FULL = 6, 3
HASH = ["high", "low"]


def line_key(line: str) -> str:
    """The line without white space at both ends, A-Z in lower case."""
    return line.strip(BLANKS).encode().translate(_LOWER).decode()


def line_keys(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """doc_id, text_key, hash and places of every distinct key of a document, whole texts read.

    ``text_key`` tells rows of one doc_id apart by their texts.
    """
    ship(docs.sparkSession)
    names = ["doc_id", "text_key", *HASH, "places"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, high, low, places = [], [], [], []
            for row, text in enumerate(batch.column(2).to_pylist()):
                found: dict[bytes, list[int]] = {}
                for place, line in enumerate(text.split("\n")):
                    line = line.strip(BLANKS)
                    if len(line) >= shortest:
                        found.setdefault(line.encode().translate(_LOWER), []).append(place)
                for key, at in found.items():
                    digest = xxhash.xxh3_128_digest(key)
                    high.append(int.from_bytes(digest[:8], signed=True))
                    low.append(int.from_bytes(digest[8:], signed=True))
                    places.append(at)
                    rows.append(row)
            at = pa.array(rows, pa.int64())
            long, lists = pa.int64(), pa.list_(pa.int32())
            columns = [batch.column(0).take(at), batch.column(1).take(at)]
            columns += [pa.array(high, long), pa.array(low, long), pa.array(places, lists)]
            yield pa.record_batch(columns, names=names)

    text = text_of("text")
    keyed = docs.select("doc_id", F.xxhash64(text).alias("text_key"), text.alias("text"))
    return keyed.mapInArrow(run, "doc_id long, text_key long, high long, low long, places array<int>")


class LineRuns:
    """Sorted runs of line hashes: high, low, holders, keeper and whether the run had it first.

    A level is a table bucketed and sorted by hash, and a run an insertion into it, so reading a
    level by hash moves no row. The number of buckets is that of the session's shuffle partitions
    when the first run is written; it and the tables' names are all that the driver holds.
    """

    def __init__(self, spark: SparkSession, full: int = FULL):
        self.spark, self.full = spark, full
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[tuple[str, int]] = []  # table and number of runs
        self.compactions = 0

    def _insert(self, run: DataFrame, level: int) -> None:
        if level == len(self.levels):
            self.levels.append(("", 0))
        name, runs = self.levels[level]
        writer = run.write.bucketBy(self.buckets, *HASH).sortBy(*HASH).mode("append")
        if not runs:
            name = f"line_runs_{uuid.uuid4().hex}"
            writer = writer.option("path", scratch_path(self.spark, "line-runs"))
        writer.saveAsTable(name)
        self.levels[level] = (name, runs + 1)

    def _merged(self, name: str) -> DataFrame:
        return self.spark.table(name).groupBy(*HASH).agg(
            F.sum("holders").alias("holders"),
            F.max(F.when(F.col("first"), F.col("keeper"))).alias("keeper"),
            F.max("first").alias("first"),
        )

    def _compact(self, level: int) -> None:
        """Make one run of a level and put it into the next."""
        name, _ = self.levels[level]
        self._insert(self._merged(name), level + 1)
        self.spark.sql(f"DROP TABLE {name}")
        self.levels[level] = ("", 0)
        self.compactions += 1

    def add(self, keys: DataFrame) -> None:
        """Merge a batch of ``line_keys`` into the runs."""
        own = keys.groupBy(*HASH).agg(F.count("*").alias("holders"), F.max("doc_id").alias("keeper"))
        new: Column = F.lit(True)
        for level, (name, runs) in enumerate(self.levels):
            if runs:
                # The anti join, kept as a mark: what no level has is new.
                known = self.spark.table(name).groupBy(*HASH).agg(F.lit(True).alias(f"in_{level}"))
                own = own.join(known.hint("merge"), HASH, "left")
                new &= F.col(f"in_{level}").isNull()
        self._insert(own.select(*HASH, "holders", "keeper", new.alias("first")), 0)
        level = 0
        while level < len(self.levels) and self.levels[level][1] >= self.full:
            self._compact(level)
            level += 1

    def totals(self) -> DataFrame:
        """One row for each hash: holders in all batches, and the keeper of the first of them.

        All levels are compacted into the last.
        """
        if not self.levels:
            raise ValueError("no batch was added")
        for level in range(len(self.levels) - 1):
            if self.levels[level][1]:
                self._compact(level)
        return self._merged(self.levels[-1][0]).drop("first")

    def close(self) -> None:
        """Take the tables out of the catalog; what was read from them must be written before."""
        for name, runs in self.levels:
            if runs:
                self.spark.sql(f"DROP TABLE {name}")
        self.levels = []


def _batch_of(docs: DataFrame, batches: int) -> Column:
    """Batch number, growing as doc_id falls; null ones come last."""
    shares = [i / batches for i in range(1, batches)]
    bounds = docs.agg(F.percentile_approx("doc_id", shares, 10_000).alias("b")).first()["b"]
    at = F.lit(0)
    for bound in sorted(set(bounds or [])):
        at = at + F.when(F.col("doc_id") > bound, 0).otherwise(1)
    return at.cast("int")


def repeated_lines(
    docs: DataFrame, holders: int = HOLDERS, shortest: int = SHORTEST, batches: int = BATCHES, full: int = FULL
) -> DataFrame:
    """doc_id, text_key and the places of the lines that go, for the documents that lose some."""
    spark = docs.sparkSession
    path = scratch_path(spark, "line-keys")
    keyed = line_keys(docs, shortest).withColumn("batch", _batch_of(docs, batches))
    keyed.write.partitionBy("batch").parquet(path)
    keys = spark.read.schema(keyed.schema).parquet(path)
    runs = LineRuns(spark, full)
    for number in range(batches):
        runs.add(keys.where(F.col("batch") == number))
    verdicts = settle(runs.totals().where(F.col("holders") >= holders).drop("holders"), "line-verdicts")
    runs.close()
    going = keys.join(verdicts, HASH).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    # Rows that repeat doc_id and text lose the same lines.
    once = going.groupBy("doc_id", "text_key", *HASH).agg(F.first("places").alias("places"))
    return once.groupBy("doc_id", "text_key").agg(F.flatten(F.collect_list("places")).alias("places"))


def drop_repeated_lines(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, text (of the lines that stay), n_lines (before) and n_dropped of every document."""
    docs = docs.select("doc_id", text_of("text").alias("text"))
    going = repeated_lines(docs, **settings).toDF("holder", "text_key", "places")
    same = F.col("doc_id").eqNullSafe(F.col("holder")) & (F.xxhash64("text") == F.col("text_key"))
    lines = F.split("text", "\n")
    # Sets of numbers, so the work follows the lines of a text, not their square.
    stay = F.array_except(F.sequence(F.lit(0), F.col("n_lines") - 1), "places")
    return (
        docs.join(going, same, "left")
        .withColumn("n_lines", F.size(lines))
        .withColumn("stay", F.when(F.col("places").isNotNull(), stay))
        .withColumn("lines", F.when(F.col("places").isNotNull(), lines))
        .select(
            "doc_id",
            F.coalesce(F.array_join(F.transform("stay", lambda i: F.get("lines", i)), "\n"), "text").alias("text"),
            F.col("n_lines").cast("long").alias("n_lines"),
            F.coalesce(F.col("n_lines") - F.size("stay"), F.lit(0)).cast("long").alias("n_dropped"),
        )
    )
