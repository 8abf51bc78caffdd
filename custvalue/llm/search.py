"""Ranked lexical search by hashed max-sketches.

The impact of a term in a document is the part of its score that the document decides, before the
term's weight. All impacts of a document fold into a sketch: its terms are hashed to coordinates,
a power of two of them that grows with the document, and each coordinate holds the largest impact
that fell there, rounded up. Most coordinates are zero, so those with an impact are stored alone.
Looking up the terms of a query therefore never gives less than the document's score. A block of queries is looked up in all sketches at once; the documents with the
highest bounds are scored exactly, which gives a threshold, and the others follow in descending
order of their bounds until these are below the threshold that the scores have reached. Texts are
only read again for documents whose bound reaches it.

Terms, N, L, n, df, tf and weights are those of ``Weights``. Weights are never negative, as df
is N at most.

Defined cases: a null or empty text has no terms, is no document of N and is never found; an item
without terms has no rows; every row of the items is ranked on its own, also where item_id is
repeated or null; rows of documents that repeat a doc_id count each, and are told apart by their
texts; equal scores are ordered by doc_id, null last, equal ones of those rows by nothing; very
long texts have large sketches and are read whole; empty tables give no rows; other columns of
both tables are ignored.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from custvalue.llm.common import settle, ship, text_of

#: A term is a run of digits, ASCII letters and bytes of other characters; A-Z in lower case.
_FOLDED = bytes(
    b if chr(b).isdigit() and b < 128 or 97 <= b <= 122 or b > 127 else b + 32 if 65 <= b <= 90 else 32
    for b in range(256)
)
#: Impacts are stored in units of this, rounded up, so that they fit 16 bits.
UNIT = 16
#: Terms (by item) and items that are looked up together.
BLOCK_ENTRIES, BLOCK_ITEMS = 20_000, 1_000
#: Distinct terms that a task counts before it hands them on.
COUNTED = 200_000
#: Numbers of a lookup that a task holds at once, and rows whose bounds it gives together.
HELD, ROWS = 2_000_000, 512
#: Coordinates of the smallest sketch, and for every distinct term of a larger one.
LEAST_SIZE, SPARSE = 1 << 16, 64
#: Texts that are scored for an item in the first round by bounds; each later one takes eight times more.
FIRST = 50


def terms_of(text: bytes) -> list[bytes]:
    """Terms of a text in UTF-8, in order."""
    return text.translate(_FOLDED).split()


@dataclass(frozen=True)
class Weights:
    """Integer scores from the number of documents with a term (N) and of all terms (L)."""

    documents: int
    terms: int

    def of_term(self, df: int) -> int:
        return math.floor(1000 * math.log((2 * self.documents + 2) / (2 * df + 1)))

    def length(self, n):
        return 100 - 25 + (25 * n * self.documents) // self.terms

    @staticmethod
    def impact(tf, m):
        return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def _blobs(docs: DataFrame, *columns) -> DataFrame:
    """The text's bytes, and columns beside them."""
    return docs.select(*columns, text_of("text").cast("binary").alias("text"))


def statistics(docs: DataFrame) -> DataFrame:
    """term, documents (that hold it) and terms (of it); the sums of both in the row without a term."""
    ship(docs.sparkSession)
    schema = pa.schema([("term", pa.binary()), ("documents", pa.int64()), ("terms", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holding, every, documents, length = Counter(), Counter(), 0, 0

        def counted():
            terms = list(holding)
            return pa.record_batch(
                [
                    pa.array([*terms, None], pa.binary()),
                    pa.array([*(holding[t] for t in terms), documents], pa.int64()),
                    pa.array([*(every[t] for t in terms), length], pa.int64()),
                ],
                schema=schema,
            )

        for batch in batches:
            for blob in batch.column(0):
                counts = Counter(terms_of(blob.as_py()))
                if counts:
                    holding.update(counts.keys())
                    every.update(counts)
                    documents, length = documents + 1, length + counts.total()
                if len(holding) > COUNTED:
                    yield counted()
                    holding, every, documents, length = Counter(), Counter(), 0, 0
        yield counted()

    partial = _blobs(docs).mapInArrow(run, "term binary, documents long, terms long")
    return partial.groupBy("term").agg(F.sum("documents").alias("documents"), F.sum("terms").alias("terms"))


def sketch_size(distinct: int) -> int:
    """Coordinates of a document's sketch."""
    return max(LEAST_SIZE, 1 << (distinct * SPARSE - 1).bit_length())


def fold(hashes: list[int], impacts: np.ndarray, size: int) -> bytes:
    """A sketch: coordinates that have an impact (32 bits each), then the largest of each (16 bits)."""
    at = np.array(hashes, np.int64) & (size - 1)
    units = (-(-impacts // UNIT)).astype(np.uint16)
    order = np.lexsort((units, at))
    at, units = at[order], units[order]
    last = np.append(at[1:] != at[:-1], True)
    return at[last].astype(np.uint32).tobytes() + units[last].tobytes()


def unfold(sketch: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates and impacts of a sketch."""
    count = len(sketch) // 6
    return np.frombuffer(sketch, np.uint32, count), np.frombuffer(sketch, np.uint16, count, 4 * count)


def sketches(docs: DataFrame, weights: Weights) -> DataFrame:
    """doc_id, text_key and the sketch, with its size, of every document that has a term."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sizes, folded = [], [], []
            for row, blob in enumerate(batch.column(2)):
                found = Counter(terms_of(blob.as_py()))
                if found:
                    tf = np.fromiter(found.values(), np.int64, len(found))
                    impacts = weights.impact(tf, weights.length(found.total()))
                    rows.append(row)
                    sizes.append(sketch_size(len(found)))
                    folded.append(fold(list(map(crc32, found)), impacts, sizes[-1]))
            there = pa.array(rows, pa.int64())
            yield pa.record_batch(
                [
                    batch.column(0).take(there),
                    batch.column(1).take(there),
                    pa.array(sizes, pa.int64()),
                    pa.array(folded, pa.binary()),
                ],
                names=["doc_id", "text_key", "size", "sketch"],
            )

    keyed = _blobs(docs, "doc_id", F.xxhash64(text_of("text")).alias("text_key"))
    return keyed.mapInArrow(run, "doc_id long, text_key long, size long, sketch binary")


@dataclass
class Block:
    """Queries that are looked up together: the terms of each with their weights."""

    item_ids: list
    weights: list[dict[bytes, int]]

    def __post_init__(self):
        entries = [(t, w) for terms in self.weights for t, w in terms.items()]
        self.hashes = np.array([crc32(t) for t, _ in entries], np.int64)
        self.factors = np.array([w * UNIT for _, w in entries], np.int64)
        self.starts = np.cumsum([0, *map(len, self.weights)])[:-1]

    def bounds(self, sizes: list[int], sketches: list[bytes]) -> Iterator[tuple[list[int], np.ndarray]]:
        """Some rows at a time: their numbers and their bounds for every item."""
        by_size = defaultdict(list)
        for row, size in enumerate(sizes):
            by_size[size].append(row)
        for size, rows in by_size.items():
            place = self.hashes & (size - 1)
            at_once = max(1, min(HELD // len(place), HELD // size))
            dense = np.zeros((min(at_once, len(rows)), size), np.uint16)
            for start in range(0, len(rows), ROWS):
                some, found = rows[start : start + ROWS], []
                for first in range(0, len(some), at_once):
                    held = [unfold(sketches[r]) for r in some[first : first + at_once]]
                    row = np.repeat(np.arange(len(held)), [len(at) for at, _ in held])
                    at = np.concatenate([at for at, _ in held])
                    dense[row, at] = np.concatenate([units for _, units in held])
                    looked_up = dense[: len(held), place] * self.factors
                    found.append(np.add.reduceat(looked_up, self.starts, axis=1))
                    dense[row, at] = 0
                yield some, np.concatenate(found)


def _blocks(items: DataFrame, terms: DataFrame, weights: Weights) -> Iterator[Block]:
    """Blocks of items, one after the other; terms that no document holds and items without terms go."""
    spark = items.sparkSession

    def block(some: list[tuple]) -> Block:
        vocabulary = {t for _, counts in some for t in counts}
        wanted = spark.createDataFrame([(bytearray(t),) for t in sorted(vocabulary)], "term binary")
        known = {bytes(r["term"]): r["documents"] for r in terms.join(wanted, "term").collect()}
        found = [
            (item, {t: c * weights.of_term(known[t]) for t, c in counts.items() if t in known})
            for item, counts in some
        ]
        found = [(item, terms) for item, terms in found if terms]
        return Block([i for i, _ in found], [t for _, t in found])

    held, entries = [], 0
    for row in _blobs(items, "item_id").toLocalIterator():
        counts = Counter(terms_of(bytes(row["text"])))
        if not counts:
            continue
        if held and (entries + len(counts) > BLOCK_ENTRIES or len(held) >= BLOCK_ITEMS):
            yield block(held)
            held, entries = [], 0
        held.append((row["item_id"], counts))
        entries += len(counts)
    if held:
        yield block(held)


_FOUND = "item int, bound long, doc_id long, text_key long"


def _found(item, bound, doc_id, text_key) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array(item, pa.int32()), pa.array(bound, pa.int64()), pa.array(doc_id, pa.int64()), pa.array(text_key, pa.int64())],
        names=["item", "bound", "doc_id", "text_key"],
    )


def highest_bounds(index: DataFrame, block: Block, k: int) -> DataFrame:
    """The ``k`` documents of each task with the highest bounds, for every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = len(block.weights)
        best = np.zeros((k, items), np.int64)
        ids = np.empty((k, items), object)
        keys = np.zeros((k, items), np.int64)
        for batch in batches:
            doc_ids = np.array([*batch.column(0).to_pylist(), None], object)
            text_keys = batch.column(1).to_numpy()
            for rows, bounds in block.bounds(*(c.to_pylist() for c in batch.columns[2:])):
                some = np.array(rows)
                # Only items that these rows change.
                for item in np.flatnonzero(bounds.max(axis=0) > best.min(axis=0)):
                    both = np.concatenate([best[:, item], bounds[:, item]])
                    top = np.argpartition(both, len(rows))[len(rows) :]
                    ids[:, item] = np.concatenate([ids[:, item], doc_ids[some]])[top]
                    keys[:, item] = np.concatenate([keys[:, item], text_keys[some]])[top]
                    best[:, item] = both[top]
        place, item = np.nonzero(best)
        yield _found(item, best[place, item], ids[place, item].tolist(), keys[place, item])

    return index.mapInArrow(run, _FOUND)


def bounds_from(index: DataFrame, block: Block, least: list[int], k: int) -> DataFrame:
    """Every document whose bound reaches what ``least`` says for the item.

    Of documents with equal texts, which have equal scores, a task names the ``k`` smallest
    doc_ids: no other can be among the first ``k``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limits = np.array(least, np.int64)
        last = float("inf")
        held: dict[tuple[int, int], tuple[int, list]] = {}
        for batch in batches:
            doc_ids, text_keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for rows, bounds in block.bounds(*(c.to_pylist() for c in batch.columns[2:])):
                at, item = np.nonzero(bounds >= limits)
                for row, i, bound in zip(at.tolist(), item.tolist(), bounds[at, item].tolist()):
                    ids = held.setdefault((i, text_keys[rows[row]]), (bound, []))[1]
                    ids.append(doc_ids[rows[row]])
                    if len(ids) > 2 * k:
                        ids.sort(key=lambda d: last if d is None else d)
                        del ids[k:]
            if len(held) > COUNTED:
                yield from given(held)
                held = {}
        yield from given(held)

    def given(held: dict) -> Iterator[pa.RecordBatch]:
        some = [(i, bound, d, key) for (i, key), (bound, ids) in held.items() for d in ids]
        if some:
            yield _found(*zip(*some))

    return index.mapInArrow(run, _FOUND)


def rescore(docs: DataFrame, wanted: DataFrame, block: Block, weights: Weights) -> DataFrame:
    """item, text_key and score of the texts and items that ``wanted`` names, from the whole texts."""
    texts = wanted.groupBy("text_key").agg(
        F.min("doc_id").alias("holder"), F.collect_set("item").alias("items")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = {t for terms in block.weights for t in terms}
        for batch in batches:
            found = []
            for key, items, blob in zip(*(c.to_pylist() for c in batch.columns)):
                terms = terms_of(blob)
                m = weights.length(len(terms))
                tf = Counter(t for t in terms if t in vocabulary)
                impact = {t: weights.impact(n, m) for t, n in tf.items()}
                found += [
                    (i, key, sum(w * impact[t] for t, w in block.weights[i].items() if t in impact)) for i in items
                ]
            item, key, score = zip(*found) if found else ((), (), ())
            yield pa.record_batch(
                [pa.array(item, pa.int32()), pa.array(key, pa.int64()), pa.array(score, pa.int64())],
                names=["item", "text_key", "score"],
            )

    # One holder of each text is read, by its doc_id; the text's hash tells rows of one doc_id apart.
    same = docs["doc_id"].eqNullSafe(texts["holder"]) & (F.xxhash64(text_of(docs["text"])) == texts["text_key"])
    read = docs.join(texts, same).select("text_key", "items", text_of(docs["text"]).cast("binary").alias("text"))
    return read.mapInArrow(run, "item int, text_key long, score long").distinct()


def _first(rows: DataFrame, k: int, *order) -> DataFrame:
    """The first ``k`` rows of each item, with their rank."""
    place = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    return rows.withColumn("rank", place).where(F.col("rank") <= k)


def _thresholds(scored: DataFrame, items: int, k: int) -> list[int]:
    """Score of the ``k``-th best document of every item so far; 1 where there are fewer."""
    found = _first(scored, k, F.desc("score")).where(F.col("rank") == k)
    least = {r["item"]: r["score"] for r in found.select("item", "score").collect()}
    return [max(1, least.get(i, 1)) for i in range(items)]


def _search_block(docs: DataFrame, index: DataFrame, block: Block, weights: Weights, k: int) -> DataFrame:
    """item, rank, doc_id and score of the best documents of a block."""
    spark, items = docs.sparkSession, len(block.weights)
    top = settle(_first(highest_bounds(index, block, k), k, F.desc("bound")).drop("rank"), "search-top")
    scored = settle(rescore(docs, top, block, weights), "search-scores")
    least = _thresholds(top.join(scored, ["item", "text_key"]), items, k)
    reaching = settle(bounds_from(index, block, least, k), "search-reaching")
    texts = settle(
        reaching.groupBy("item", "text_key")
        .agg(F.max("bound").alias("bound"), F.min("doc_id").alias("doc_id"))
        .join(scored, ["item", "text_key"], "left_anti"),
        "search-texts",
    )
    size = FIRST
    while True:
        limits = spark.createDataFrame(list(enumerate(least)), "item int, least long")
        waiting = texts.join(limits, "item").where("bound >= least").drop("least")
        some = settle(_first(waiting, size, F.desc("bound"), "text_key").drop("rank"), "search-round")
        if some.isEmpty():
            break
        scored = settle(scored.unionByName(rescore(docs, some, block, weights)), "search-scores")
        least = _thresholds(reaching.join(scored, ["item", "text_key"]), items, k)
        texts = settle(texts.join(some, ["item", "text_key"], "left_anti"), "search-texts")
        size *= 8
    found = reaching.join(scored.where("score > 0"), ["item", "text_key"])
    return _first(found, k, F.desc("score"), F.asc_nulls_last("doc_id")).select("item", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` best documents for every row of ``items``.

    Items come to the driver a block at a time, as the queries that tasks look up.
    """
    spark, docs = docs.sparkSession, docs.select("doc_id", "text")
    terms = settle(statistics(docs), "search-terms")
    total = terms.where("term is null").first()
    result = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    if total is None or not total["documents"]:
        return result
    weights = Weights(total["documents"], total["terms"])
    index = settle(sketches(docs, weights), "search-index")
    for block in _blocks(items, terms, weights):
        if not block.weights:
            continue
        found = settle(_search_block(docs, index, block, weights, k), "search-found")
        names = spark.createDataFrame(list(enumerate(block.item_ids)), "item int, item_id long")
        result = result.unionByName(found.join(names, "item").select(*result.columns))
    return result
