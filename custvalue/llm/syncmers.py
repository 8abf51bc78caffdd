"""Document fingerprints from closed syncmers over words, in SQL functions only.

Every five consecutive words are a k-mer; its inner substrings are its four pairs of words. The
k-mer is an anchor if the smallest pair hash lies at an edge, first or last. That depends on the
k-mer alone, so an edit changes only the anchors that contain it.

With ``size`` None a fingerprint is every distinct anchor hash of 64 bits, the likeness of two is
the share of common hashes among all of both, and each anchor comes with its position, which
matching of passages joins on. With a number it is a sketch: that many smallest hashes of 32 bits,
whose likeness is an estimate from the smallest of both; long texts can differ and have like ones.

Words are runs without ASCII white space; a code point from U+2E80 on, where scripts do without
spaces, is a word of its own.

Defined cases: a null text counts as empty; no words give an empty fingerprint, and two empty
ones have likeness 1; a text without an anchor, as any of fewer than five words, has the hash of
all its words as the only one; rows that share a doc_id are ordered by the hash of their text and
are each other's next; a null doc_id comes last; the next document of a single row is itself;
other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custvalue.llm.common import SPACE, text_of

KMER, PAIR = 5, 2
#: Hashes of a sketch, each of 32 bits.
SIZE = 64
#: Ranges of doc_id per shuffle partition.
RANGES = 4


def _hash(size: int | None, *columns: Column) -> Column:
    found = F.xxhash64(*columns)
    return found if size is None else F.shiftrightunsigned(found, 32)


def _words(text: str) -> Column:
    apart = F.regexp_replace(text, r"([\x{2E80}-\x{10FFFF}])", " $1 ")
    return F.split(F.btrim(apart, F.lit(" \t\n\x0b\x0c\r")), f"[{SPACE}]+")


def _with_pairs(df: DataFrame, text: str) -> DataFrame:
    """Add the hashes of words and of pairs of words; no pairs where there is no k-mer.

    Each step is a column of its own, so that it is evaluated once per row.
    """
    # Splitting an empty text gives one empty word.
    hashes = F.transform(F.array_remove(_words(text), ""), lambda w: F.xxhash64(w))
    df = df.withColumn("_words", hashes)
    less = F.size("_words") - 1
    pairs = F.zip_with(
        F.slice("_words", 1, less), F.slice("_words", 2, less), lambda a, b: F.xxhash64(a, b)
    )
    return df.withColumn("_pairs", F.when(F.size("_words") >= KMER, pairs))


def with_anchors(
    df: DataFrame, text: str, out: str, size: int | None = SIZE, at: str | None = None
) -> DataFrame:
    """Add ``out``, the distinct anchor hashes of the column ``text`` in order, or the first of them.

    ``at`` names a further column with the position of the first word and the hash of every anchor.
    """
    df = _with_pairs(df, text)

    def pair(i: Column, step: int) -> Column:
        return F.get("_pairs", i + step)

    closed = F.transform(
        F.sequence(F.lit(0), F.size("_pairs") - (KMER - PAIR + 1)),
        lambda i: F.when(
            F.least(pair(i, 0), pair(i, 3)) <= F.least(pair(i, 1), pair(i, 2)),
            F.struct(
                i.alias("position"), _hash(size, pair(i, 0), pair(i, 2), pair(i, 3)).alias("hash")
            ),
        ),
    )
    df = df.withColumn("_anchors", F.when(F.col("_pairs").isNotNull(), F.array_compact(closed)))
    whole = F.array(
        F.struct(F.lit(0).alias("position"), _hash(size, F.col("_words")).alias("hash"))
    )
    nothing = F.array().cast("array<struct<position:int,hash:bigint>>")
    df = df.withColumn(
        "_anchors",
        F.when(F.size("_anchors") > 0, F.col("_anchors"))
        .when(F.size("_words") > 0, whole)
        .otherwise(nothing),
    )
    hashes = F.sort_array(F.array_distinct(F.col("_anchors.hash")))
    df = df.withColumn(out, hashes if size is None else F.slice(hashes, 1, size))
    return (df.withColumn(at, F.col("_anchors")) if at else df).drop("_words", "_pairs", "_anchors")


def as_text(hashes: str | Column, size: int | None = SIZE) -> Column:
    """Eight hexadecimal digits per hash of a sketch, sixteen otherwise."""
    digits = 16 if size is None else 8
    return F.array_join(F.transform(hashes, lambda h: F.lower(F.lpad(F.hex(h), digits, "0"))), "")


def likeness(a: str, b: str, size: int | None = SIZE) -> Column:
    """Share of common hashes among those of both, of sketches among the smallest ones."""
    none = (F.size(a) == 0) & (F.size(b) == 0)
    if size is None:
        common = F.size(F.array_intersect(a, b))
        return F.when(none, 1.0).otherwise(common / (F.size(a) + F.size(b) - common))
    smallest = F.slice(F.sort_array(F.array_union(a, b)), 1, size)
    both = F.size(F.array_intersect(smallest, F.array_intersect(a, b)))
    return F.when(none, 1.0).otherwise(both / F.size(smallest))


def positions(docs: DataFrame, size: int | None = SIZE) -> DataFrame:
    """doc_id, position (of the first word) and hash of every anchor, for positional matching."""
    df = _with_pairs(docs.select("doc_id", text_of("text").alias("text")), "text")
    at = [F.get("_pairs", F.col("position") + j).alias(f"p{j}") for j in range(KMER - PAIR + 1)]
    last = F.size("_pairs") - (KMER - PAIR + 1)
    return (
        df.where("_pairs is not null")
        .select("doc_id", "_pairs", F.explode(F.sequence(F.lit(0), last)).alias("position"))
        .select("doc_id", "position", *at)
        .where(F.least("p0", "p3") <= F.least("p1", "p2"))
        .select("doc_id", "position", _hash(size, F.col("p0"), F.col("p2"), F.col("p3")).alias("hash"))
    )


def _by_range(docs: DataFrame) -> DataFrame:
    """Rows with their range of doc_id, and before each range the row that precedes it.

    The rows of a doc_id that fills several ranges, or of none, are dealt over as many slices by the
    hash of their text, so a range has about the same number of rows whatever the ids. The last row
    of a range is sent to the range above it too, the last of all to the lowest one; those guests
    have ``own`` false. So the row before any row is in its range. Only the bounds of the ranges
    come to the driver.
    """
    spark = docs.sparkSession
    count = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    fractions = [i / count for i in range(1, count)]
    head = docs.agg(
        F.percentile_approx("doc_id", fractions, 10_000).alias("bounds"),
        F.count("*").alias("rows"),
        F.count_if(F.col("doc_id").isNull()).alias("without"),
    ).first()
    often = Counter(head["bounds"] or [])
    limits = F.array(*(F.lit(b) for b in sorted(often))).cast("array<bigint>")
    slices = F.array(*(F.lit(often[b]) for b in sorted(often))).cast("array<int>")
    # The number of bounds below the doc_id; null ones form the lowest range.
    below = F.size(F.filter(limits, lambda b: b < F.col("doc_id")))
    is_bound = F.get(limits, below) == F.col("doc_id")
    share = F.when(F.col("doc_id").isNull(), 1 + count * head["without"] // max(1, head["rows"]))
    share = share.when(is_bound & (F.get(slices, below) > 1), F.get(slices, below))
    place = F.floor((F.col("hash") / F.lit(2.0**64) + 0.5) * share)
    ranged = docs.withColumns(
        {
            "hash": F.xxhash64("text"),
            "range": F.when(F.col("doc_id").isNull(), -1).otherwise(below),
        }
    ).withColumn("slice", F.coalesce(F.least(place, share - 1), F.lit(-1)).cast("int"))
    last = F.max(F.struct("doc_id", "hash")).alias("last")
    tops = ranged.groupBy("range", "slice").agg(last).orderBy("range", "slice").collect()
    before = [tops[-1], *tops[:-1]] if tops else []
    sent = [(*low["last"], high["range"], high["slice"]) for low, high in zip(before, tops)]
    # One row per range.
    to = F.broadcast(spark.createDataFrame(sent, "last_id long, last_hash long, to int, to_slice int"))
    same = F.col("doc_id").eqNullSafe(F.col("last_id")) & (F.col("hash") == F.col("last_hash"))
    # Of equal rows one is sent.
    guests = (
        ranged.join(to, same)
        .groupBy(F.col("to").alias("range"), F.col("to_slice").alias("slice"))
        .agg(*(F.max(c).alias(c) for c in ("doc_id", "text", "hash")), F.lit(False).alias("own"))
    )
    return ranged.withColumn("own", F.lit(True)).unionByName(guests)


def edit_likeness(docs: DataFrame, size: int | None = SIZE) -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likenesses.

    The edited text has its last third replaced by the start of the next document by
    descending doc_id. Texts are shuffled once, without hashes, as those of a text are as large.
    With ``size`` None the positions of the text's anchors are a further column.
    """
    rows = _by_range(docs.select("doc_id", text_of("text").alias("text")))
    # The next document by descending doc_id is the one before in ascending order.
    order = Window.partitionBy("range", "slice").orderBy(
        "own", F.col("doc_id").asc_nulls_first(), "hash", "text"
    )
    third = F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.length("text") - third),
        F.substring(F.col("next_text"), F.lit(1), third),
    )
    rows = (
        rows.withColumn("next_text", F.lag("text").over(order))
        .where("own")
        .select("doc_id", "text", "next_text", edited.alias("edited"))
    )
    rows = with_anchors(rows, "text", "hashes", size, "positions")
    rows = with_anchors(rows, "next_text", "next_hashes", size).drop("next_text")
    rows = with_anchors(rows, "edited", "edited_hashes", size)
    return rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text("hashes", size).alias("fingerprint"),
        as_text("edited_hashes", size).alias("edited_fingerprint"),
        likeness("hashes", "edited_hashes", size).alias("near_edited"),
        likeness("hashes", "next_hashes", size).alias("near_next"),
        *(["positions"] if size is None else []),
    )
