"""Exact duplicates of documents by an index of live digests in cuckoo filters.

Texts are equal if they are identical without white space; equality is decided on the SHA-256 of
that text. The index has one row per live digest, dealt over 65,536 shards by its first two
bytes; a task holds one shard at a time (760,000 digests of 5e10), whose cuckoo filter takes the
stored digests first and then the new ones. Filter hits are verified against the stored digests,
misses are new.

The rows of one digest are first summed within 16 salts, so a group with a third of all rows
reaches its shard as at most 16 rows.

Defined cases: a null text counts as empty, and empty texts equal each other; rows that repeat
doc_id and text are told apart by nothing, so ``exact_groups`` keeps each of them if their doc_id
stays, and ``drop_copies`` one; a null doc_id stays only if no equal text of that length has one; an empty table gives an empty result; other
columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custvalue.llm.common import fresh, settle, ship, text_of
from custvalue.llm.cuckoo import CuckooIndex

BLANKS = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
SALTS = 16
INDEX = "digest binary, members long, chars long, holder long"


def normalized(text: Column) -> Column:
    """The text without white space."""
    return reduce(lambda t, b: F.replace(t, F.lit(b), F.lit("")), BLANKS, text)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, chars (code points of the original text) and text_sha256 of every document."""
    text = text_of("text")
    return docs.select(
        "doc_id",
        F.length(text).cast("long").alias("chars"),
        F.sha2(normalized(text), 256).alias("text_sha256"),
    )


def _summed(rows: DataFrame) -> DataFrame:
    """Members and best row of each digest and salt, in the form of index rows."""
    # The most characters, then the smallest doc_id; a null one comes last.
    first = [(-F.col("chars")).alias("fewer"), F.col("doc_id").isNull().alias("unnamed"), "chars", "doc_id"]
    best = F.min(F.struct(*first)).alias("best")
    return (
        rows.groupBy("text_sha256", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt"))
        .agg(F.count("*").alias("members"), best)
        .select(
            F.unhex("text_sha256").alias("digest"),
            "members",
            F.col("best.chars").alias("chars"),
            F.col("best.doc_id").alias("holder"),
        )
    )


def _better(chars: int, holder: int | None, than_chars: int, than_holder: int | None) -> bool:
    if chars != than_chars:
        return chars > than_chars
    if holder is None or than_holder is None:
        return holder is not None
    return holder < than_holder


class Shard:
    """Index rows of one shard, held by its cuckoo filter."""

    def __init__(self, number: int):
        self.number = number
        self.filter = CuckooIndex()

    def add(self, digest: bytes, members: int, chars: int, holder: int | None) -> None:
        if self.filter.insert(digest, [members, chars, holder]):
            return
        row = self.filter.get(digest)
        row[0] += members
        if _better(chars, holder, row[1], row[2]):
            row[1:] = [chars, holder]

    def remove(self, digest: bytes) -> None:
        self.filter.delete(digest)

    def live(self) -> list[tuple]:
        return [(digest, *row) for digest, row in self.filter.items()]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    arrays = [pa.array(columns[0], pa.binary()), *(pa.array(c, pa.int64()) for c in columns[1:])]
    return pa.record_batch(arrays, names=["digest", "members", "chars", "holder"])


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Insert rows in the order of their shards, deletions last; one shard is held at a time."""
    shard, done = None, []
    for batch in batches:
        for number, drop, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if shard is None or number != shard.number:
                done += shard.live() if shard else []
                shard = Shard(number)
                if len(done) >= 10_000:
                    yield _batch(done)
                    done = []
            if drop:
                shard.remove(row[0])
            else:
                shard.add(*row)
    done += shard.live() if shard else []
    if done:
        yield _batch(done)


def update(
    rows: DataFrame, index: DataFrame | None = None, deleted: DataFrame | None = None
) -> DataFrame:
    """Index rows after inserting ``rows`` (of ``digests``) and deleting digests.

    ``index`` is what an earlier call returned, stored as a table. ``deleted`` has a column
    text_sha256; those digests are no longer live afterwards, whatever was inserted.
    """
    ship(rows.sparkSession)
    columns = ["digest", "members", "chars", "holder"]
    changes = _summed(rows)
    if index is not None:
        changes = index.select(*columns).unionByName(changes)
    changes = changes.withColumn("dropped", F.lit(False))
    if deleted is not None:
        nothing = [F.lit(None).cast("long").alias(c) for c in columns[1:]]
        dropped = deleted.select(F.unhex("text_sha256").alias("digest"), *nothing)
        changes = changes.unionByName(dropped.withColumn("dropped", F.lit(True)))
    # The shard is the first two bytes of the digest.
    shard = F.conv(F.substring(F.hex("digest"), 1, 4), 16, 10).cast("int").alias("shard")
    return (
        changes.select(shard, "dropped", *columns)
        .repartition("shard")
        .sortWithinPartitions("shard", "dropped")
        .mapInArrow(_apply, INDEX)
    )


def exact_groups(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every document.

    Only digests of more than one row are joined back: if they are few, Spark sends them to the
    documents, else it splits a hot digest as a skewed join.
    """
    rows = settle(digests(docs), "digests")
    groups = (
        update(rows)
        .where("members > 1")
        .select(
            F.lower(F.hex("digest")).alias("text_sha256"),
            F.col("holder").alias("keeper"),
            "members",
            F.col("chars").alias("most"),
        )
    )
    alone = F.col("members").isNull()
    stays = F.col("doc_id").eqNullSafe(F.col("keeper")) & (F.col("chars") == F.col("most"))
    return rows.join(groups, "text_sha256", "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keeper")).alias("keep_id"),
        F.coalesce("members", F.lit(1)).cast("long").alias("group_size"),
        (alone | stays).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, columns unchanged; of repeated rows one.

    The rows that go are joined away by doc_id and digest, so documents are only shuffled where
    those rows are too many to send to them.
    """
    verdicts = settle(exact_groups(docs), "verdicts")
    going = verdicts.where("not kept").select("doc_id", "text_sha256").distinct()
    repeated = (
        verdicts.where("kept and group_size > 1")
        .groupBy("doc_id", "text_sha256")
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )

    own_id, own_digest = fresh(docs, "own_id", "own_digest")

    def rows_in(found: DataFrame, how: str) -> DataFrame:
        found = found.toDF(own_id, own_digest)
        digest = F.sha2(normalized(text_of(docs["text"])), 256)
        same = docs["doc_id"].eqNullSafe(found[own_id]) & (digest == found[own_digest])
        return docs.join(found, same, how)

    once = rows_in(repeated, "inner").dropDuplicates([own_id, own_digest])
    return rows_in(going.unionByName(repeated), "left_anti").unionByName(once.select(docs.columns))
