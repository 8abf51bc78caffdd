"""Language of documents by rank-order profiles of character n-grams.

The profile of a language is its most frequent n-grams in order; a document's own most frequent
n-grams are compared with each by out-of-place distance, the sum of rank differences, where an
n-gram that a profile lacks counts as the full profile length. The nearest profile wins, the
first by name of equally near ones.

n-grams are one to three lower-case characters of a word with a blank on each side, as numbers
of 21 bits per character. Equally frequent ones rank by that number.

A text unlike every language is told by its score. Text of a language that was not learned, and
letters without a language, score about a third of what text of the nearest language does, so a
text is rejected below ``SHARE`` of the median score of the learning texts that are nearest to
the same language and have about as many n-grams, as short texts score otherwise than long ones.

Defined cases: a null text and one without a letter are ``und`` with score 0, as is everything if
no profile was learned; rows without a language teach nothing; very long texts are counted whole,
a block of characters at a time; repeated rows are all counted and judged alike; other columns of
the input are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custvalue.llm.common import ship

UNDETERMINED = "und"
#: n-grams of a profile.
PROFILE = 300
#: Characters of a text, and n-grams of a task's counts, that are held at once.
BLOCK, HELD = 1 << 20, 1 << 19
BLANK, BITS = 32, 21
#: Share of a median score that a text has to reach, and texts that a median needs.
SHARE, LEARNT = 0.45, 50
#: Steps of a score that are counted apart for the medians.
STEPS = 10_000

Profiles = dict[str, list[int]]
#: Least score by language and class of n-gram numbers; class None is for all others.
Limits = dict[tuple[str, int | None], float]


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _spelled(text: str) -> np.ndarray:
    """Lower-case letters with single blanks for all else, at both ends too."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4")
    points = np.where(_letters()[points], points, BLANK)
    blank = points == BLANK
    return points[np.concatenate(([True], ~(blank[1:] & blank[:-1])))]


def _merged(grams: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, places = np.unique(np.concatenate(grams), return_inverse=True)
    return keys, np.bincount(places, np.concatenate(counts), len(keys)).astype(np.int64)


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of a text in order, and how often each occurs."""
    points = _spelled(text).astype(np.int64)
    grams, counts = [], []
    for start in range(0, len(points), BLOCK):
        a = points[start : start + BLOCK + 2]
        one, two, three = a[:BLOCK], a[: BLOCK + 1], a
        pairs = two[:-1] << BITS | two[1:]
        triples = (three[:-2] << BITS | three[1:-1]) << BITS | three[2:]
        found = np.concatenate((one[one != BLANK], pairs, triples[three[1:-1] != BLANK]))
        keys, n = np.unique(found, return_counts=True)
        grams.append(keys)
        counts.append(n)
    return (grams[0], counts[0]) if len(grams) == 1 else _merged(grams, counts)


def ranked(keys: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams."""
    return keys[np.argsort(-counts, kind="stable")[:size]]


def profiles(docs: DataFrame, size: int = PROFILE) -> Profiles:
    """Profile of every language in ``docs`` (text, lang), learned from all its rows.

    Tasks count n-grams; Spark adds the counts and keeps the first ``size`` of a language,
    within tasks first. Only the profiles come to the driver.
    """
    ship(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def passed_on(lang: str, parts: list) -> pa.RecordBatch:
            keys, n = _merged([k for k, _ in parts], [n for _, n in parts])
            return pa.record_batch(
                [pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(n)],
                names=["lang", "gram", "n"],
            )

        held: dict[str, list] = {}
        size = 0
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = gram_counts(text)
                held.setdefault(lang, []).append(found)
                size += len(found[0])
                if size > HELD:  # merge what texts share, and pass it on if that is still much
                    held = {name: [_merged(*map(list, zip(*parts)))] for name, parts in held.items()}
                    size = sum(len(parts[0][0]) for parts in held.values())
                    if size > HELD // 2:
                        for name, parts in held.items():
                            yield passed_on(name, parts)
                        held, size = {}, 0
        for lang, parts in held.items():
            yield passed_on(lang, parts)

    counted = (
        docs.where("text is not null and lang is not null")
        .select("text", "lang")
        .mapInArrow(count, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    rows = (
        counted.withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= size)
        .orderBy("lang", "place")
        .collect()
    )
    found: Profiles = {}
    for row in rows:
        found.setdefault(row["lang"], []).append(row["gram"])
    return found


class Judge:
    """Nearest language of a text, with the ranks of all profiles in one table."""

    def __init__(self, learned: Profiles, size: int = PROFILE):
        self.size, self.names = size, sorted(learned)
        self.keys = np.unique([g for p in learned.values() for g in p]).astype(np.int64)
        self.ranks = np.full((len(self.keys), len(self.names)), -1)
        for j, name in enumerate(self.names):
            self.ranks[np.searchsorted(self.keys, learned[name]), j] = np.arange(len(learned[name]))

    def nearest(self, text: str | None) -> tuple[str, float]:
        """Language and score: 1 for the profile's own order, 0 for nothing shared."""
        return self.measured(text)[:2]

    def measured(self, text: str | None) -> tuple[str, float, int]:
        """Language, score and class of the number of n-grams: n is up to two to its power."""
        if not text or not self.names:
            return UNDETERMINED, 0.0, 0
        keys, counts = gram_counts(text)
        if not len(keys):
            return UNDETERMINED, 0.0, 0
        own = ranked(keys, counts, self.size)
        places = np.searchsorted(self.keys, own).clip(max=len(self.keys) - 1)
        ranks = np.where((self.keys[places] == own)[:, None], self.ranks[places], -1)
        apart = np.where(ranks < 0, self.size, abs(ranks - np.arange(len(own))[:, None]))
        total = apart.sum(axis=0)
        best = int(total.argmin())
        score = float(1 - total[best] / (self.size * len(own)))
        return self.names[best], score, (len(own) - 1).bit_length()


def identify(docs: DataFrame, learned: Profiles, size: int = PROFILE) -> DataFrame:
    """doc_id, lang_pred and score of every document, from its whole text."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(learned, size)
        for batch in batches:
            found = [judge.nearest(t) for t in batch.column(1).to_pylist()]
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                names=["doc_id", "lang_pred", "score"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double"
    )


def held_out(divisor: int, remainder: int) -> Column:
    """Whether a document belongs to the part that no model learns from."""
    code = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(code % divisor == remainder, F.lit(False))


def limits(docs: DataFrame, learned: Profiles) -> Limits:
    """Scores below which a text is unlike its nearest language, from all rows with a language.

    A median of fewer than ``LEARNT`` texts says little: a class with fewer takes that of its
    language, and a language with fewer has no limit. Tasks count scores in steps; Spark adds the
    counts and takes the medians, which alone come to the driver.
    """
    ship(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge, found = Judge(learned), Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                lang, score, grams = judge.measured(text)
                if lang != UNDETERMINED:
                    found[lang, grams, int(score * STEPS)] += 1
        keys = list(found)
        yield pa.record_batch(
            [
                pa.array([k[0] for k in keys], pa.string()),
                pa.array([k[1] for k in keys], pa.int32()),
                pa.array([k[2] for k in keys], pa.int32()),
                pa.array(list(found.values()), pa.int64()),
            ],
            names=["lang", "grams", "step", "n"],
        )

    rows = (
        docs.where("text is not null and lang is not null")
        .select("text")
        .mapInArrow(count, "lang string, grams int, step int, n long")
        .groupBy("lang", "grams", "step")
        .agg(F.sum("n").alias("n"))
        .rollup("lang", "grams")
        .agg(F.sum("n").alias("n"), F.percentile("step", 0.5, F.col("n")).alias("step"))
        .where((F.col("n") >= LEARNT) & F.col("lang").isNotNull())
        .collect()
    )
    return {(r["lang"], r["grams"]): SHARE * r["step"] / STEPS for r in rows}


def keep_identified(
    docs: DataFrame, learned: Profiles, least: float = 0.05, known: Limits | None = None
) -> DataFrame:
    """Documents with a determined language and a score that is high enough, columns unchanged.

    High enough is ``least``, and what ``known`` (of ``limits``) has for the nearest language.
    """
    ship(docs.sparkSession)
    known = known or {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(learned)

        def fits(text: str | None) -> bool:
            lang, score, grams = judge.measured(text)
            limit = known.get((lang, grams), known.get((lang, None), least))
            return lang != UNDETERMINED and score >= max(least, limit)

        for batch in batches:
            found = [fits(t) for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(found, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
