"""Toxic spans and document scores by a linear-chain conditional random field.

Labels are known for documents, not for tokens. Tokens are labelled first: a word, or a word
start, whose occurrences lie in toxic documents far more often than chance allows marks its
tokens in toxic documents. Occurrences are counted by their neighbours, each context once, so
copies and near copies of a document do not speak for its other words. A chain of two states
(plain, toxic) over word features is then fitted to windows of labelled tokens. On a document,
forward and backward passes give every token's marginal; the score is the largest one, and runs
of tokens at 0.5 or more are the offending spans.

The fit uses a bounded sample of the labelled documents (``TOXIC_DOCS``, ``CLEAN_DOCS``). Tokens
are counted and marked in whole texts of them; the windows of the chain lie at up to ``MARKED``
marked tokens and ``WINDOWS`` others of each, chosen by hash over all places of the text, so a
long text teaches from all its parts. Scores cover every document. With two states the forward
pass needs one number per token, the ratio of the states' weights, so a pass is linear and
cannot underflow.

Defined cases: a null text or one without a word scores 0; very long texts are scored whole; labels that repeat a document count as
toxic if one of them is; null labels and labels of absent documents are ignored; without a toxic
example everything scores 0; repeated rows are scored alike; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import nsmallest
from itertools import accumulate
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custvalue.llm.common import settle, ship

WORD = re.compile(r"\w+")
#: Documents of each label that a fit reads at most, those with the smallest hashes.
TOXIC_DOCS, CLEAN_DOCS = 4000, 8000
#: Windows of a document around marked tokens and around any, tokens to each side.
MARKED, WINDOWS, SIDE = 16, 4, 5
STARTS = (3, 4, 5, 6)
DIMENSION = 1 << 18
ROUNDS, RATE, PENALTY = 80, 0.3, 1e-4
REMEMBERED = 200_000


def features(word: str) -> list[str]:
    """The word and its starts, told apart by a mark."""
    return [f"={word}", *(f"^{word[:n]}" for n in STARTS if len(word) > n)]


def _slots(word: str) -> list[int]:
    return [zlib.crc32(f.encode()) & (DIMENSION - 1) for f in features(word)]


@dataclass
class Chain:
    """Weights of the toxic state against the plain one, by feature slot and transition."""

    weights: np.ndarray
    bias: float
    moves: np.ndarray  # (from, to)

    def emission(self, word: str) -> float:
        total = self.bias + sum(float(self.weights[s]) for s in _slots(word))
        return math.exp(max(-50.0, min(50.0, total)))

    def odds(self, ratios: list[float]) -> list[float]:
        """Odds of the toxic state of every token, from its emission ratios."""
        (a, b), (c, d) = np.exp(self.moves).tolist()  # plain-plain, plain-toxic, toxic-...
        forward = list(accumulate(ratios, lambda r, e: e * (b + d * r) / (a + c * r)))
        # Backward: ratio of what follows a toxic and a plain token.
        backward = list(
            accumulate(ratios[:0:-1], lambda r, e: (c + d * e * r) / (a + b * e * r), initial=1.0)
        )
        return list(map(mul, forward, reversed(backward)))


def fit_chain(words: list[list[str | None]], labels: np.ndarray) -> Chain:
    """Fit by gradient ascent on the likelihood of the windows; all have one length.

    ``None`` stands for a place outside the document; it has no features.
    """
    count, size = labels.shape
    known: dict[str, int] = {}
    ids = np.array([[known.setdefault(w, len(known)) if w is not None else -1 for w in row] for row in words])
    slots = [_slots(w) for w in known]
    flat = np.array([s for row in slots for s in row], np.int64)
    owner = np.repeat(np.arange(len(slots)), [len(r) for r in slots])
    used, flat = np.unique(flat, return_inverse=True)
    weights, bias, moves = np.zeros(len(used)), np.zeros(1), np.zeros((2, 2))
    parameters = [weights, bias, moves]
    first = [np.zeros_like(p) for p in parameters]
    second = [np.zeros_like(p) for p in parameters]
    inside = ids >= 0
    for step in range(1, ROUNDS + 1):
        by_word = np.bincount(owner, weights[flat], len(slots)) + bias[0]
        e = np.where(inside, by_word[ids], 0.0)
        emit = np.stack([np.zeros_like(e), e], axis=2)
        alpha, beta = np.zeros((count, size, 2)), np.zeros((count, size, 2))
        alpha[:, 0] = emit[:, 0]
        for t in range(1, size):
            alpha[:, t] = emit[:, t] + np.logaddexp.reduce(alpha[:, t - 1, :, None] + moves, axis=1)
        for t in range(size - 2, -1, -1):
            beta[:, t] = np.logaddexp.reduce(moves + (emit[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
        total = np.logaddexp.reduce(alpha[:, -1], axis=1)
        marginal = np.exp(alpha[:, :, 1] + beta[:, :, 1] - total[:, None])
        rest = np.where(inside, labels - marginal, 0.0)
        per_word = np.bincount(ids[inside], rest[inside], len(slots))
        move_rest = np.zeros((2, 2))
        for t in range(1, size):
            pair = alpha[:, t - 1, :, None] + moves + (emit[:, t] + beta[:, t])[:, None, :]
            expected = np.exp(pair - total[:, None, None]).sum(axis=0)
            seen = np.zeros((2, 2))
            np.add.at(seen, (labels[:, t - 1], labels[:, t]), 1)
            move_rest += seen - expected
        gradients = [
            np.bincount(flat, per_word[owner], len(used)) / count - PENALTY * weights,
            np.array([rest.sum()]) / count,
            move_rest / count - PENALTY * moves,
        ]
        for p, g, m, v in zip(parameters, gradients, first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    full = np.zeros(DIMENSION)
    full[used] = weights
    return Chain(full, float(bias[0]), moves)


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts and labels of the bounded sample."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id")
    known = known.agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    parts = [
        known.where(F.col("toxic") == value).orderBy(*order).limit(most)
        for value, most in ((1, TOXIC_DOCS), (0, CLEAN_DOCS))
    ]
    # At most TOXIC_DOCS + CLEAN_DOCS rows of two numbers are sent to the documents.
    ids = F.broadcast(parts[0].unionByName(parts[1]))
    return docs.where("text is not null").select("doc_id", "text").join(ids, "doc_id").drop("doc_id")


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 100):
            part = batch.slice(start, 100)
            found: dict[tuple[str, int], int] = {}
            for text, toxic in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                words = WORD.findall(text.lower())
                for before, word, after in zip(["", *words], words, [*words[1:], ""]):
                    key = (word, zlib.crc32(f"{before} {after}".encode()))
                    found[key] = min(toxic, found.get(key, 1))
            yield pa.record_batch(
                [
                    pa.array([k[0] for k in found], pa.string()),
                    pa.array([k[1] for k in found], pa.int64()),
                    pa.array(list(found.values()), pa.int32()),
                ],
                names=["word", "context", "toxic"],
            )


def lexicon(sample: DataFrame) -> set[str]:
    """Features whose contexts are toxic far more often than chance allows.

    The measure is the log-likelihood ratio; its threshold grows with the logarithm of the
    number of features, as many are tried. They are words of the bounded sample.
    """
    by_word = (
        sample.mapInArrow(_contexts, "word string, context long, toxic int")
        .groupBy("word", "context")
        .agg(F.min("toxic").alias("toxic"))
        .groupBy("word")
        .agg(F.count("*").alias("n"), F.sum("toxic").alias("k"))
    )
    starts = [
        F.when(F.length("word") > n, F.concat(F.lit("^"), F.substring("word", 1, n))) for n in STARTS
    ]
    names = F.array_compact(F.array(F.concat(F.lit("="), "word"), *starts))
    by_feature = (
        by_word.select(F.explode(names).alias("feature"), "n", "k")
        .groupBy("feature")
        .agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    )
    total = by_word.agg(F.sum("n").alias("n"), F.sum("k").alias("k"), F.count("*").alias("words")).first()
    if not total["k"]:
        return set()
    rate = total["k"] / total["n"]

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    n, k = F.col("n").cast("double"), F.col("k").cast("double")
    ratio = 2 * (part(k, n * rate) + part(n - k, n * (1 - rate)))
    # A word that only toxic documents have; label noise may hide a few of its contexts.
    found = (
        by_feature.where((k / n > 0.7) & (k >= 3))
        .withColumn("ratio", ratio)
        .where(F.col("ratio") > 2 * math.log(total["words"]) + 2)
        .collect()
    )
    return {r["feature"] for r in found}


def _chosen(text: str, places: list[int], most: int) -> list[int]:
    """Places by the hash of the text and the place."""
    seed = zlib.crc32(text.encode())
    return nsmallest(most, places, key=lambda i: (zlib.crc32(b"%d" % i, seed), i))


def _windows(marks: set[str]):
    """Windows of a document: around marked tokens, and around others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, flags = [], []
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = WORD.findall(text.lower())
                found = {w: any(f in marks for f in features(w)) for w in set(words)}
                marked = [i for i, w in enumerate(words) if found[w]]
                others = [i for i, w in enumerate(words) if not found[w]]
                at = [*_chosen(text, marked, MARKED), *_chosen(text, others, WINDOWS)]
                marked = set(marked)
                for center in at:
                    places = range(center - SIDE, center + SIDE + 1)
                    rows.append([words[i] if 0 <= i < len(words) else None for i in places])
                    flags.append([int(toxic == 1 and i in marked) for i in places])
            yield pa.record_batch(
                [pa.array(rows, pa.list_(pa.string())), pa.array(flags, pa.list_(pa.int32()))],
                names=["words", "flags"],
            )

    return run


def fit(docs: DataFrame, labels: DataFrame) -> Chain | None:
    """Learn from a bounded sample of the labelled documents; None without toxic examples.

    The windows that come to the driver are at most MARKED + WINDOWS per sampled document, of
    eleven words each.
    """
    ship(docs.sparkSession)
    sample = settle(_sample(docs, labels), "toxic-sample")
    marks = lexicon(sample)
    if not marks:
        return None
    rows = sample.mapInArrow(_windows(marks), "words array<string>, flags array<int>").collect()
    rows.sort(key=lambda r: [w or "" for w in r["words"]])
    return fit_chain([r["words"] for r in rows], np.array([r["flags"] for r in rows]))


class _Scorer:
    def __init__(self, chain: Chain):
        self.chain = chain
        self.known: dict[str, float] = {}

    def ratio(self, word: str) -> float:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            found = self.known[word] = self.chain.emission(word)
        return found

    def odds(self, text: str) -> list[float]:
        return self.chain.odds(list(map(self.ratio, WORD.findall(text.lower()))))

    def judge(self, text: str) -> tuple[float, list[dict[str, int]]]:
        """Score, and start and end (code points) of the spans."""
        odds = self.odds(text)
        top = max(odds, default=0.0)
        if top < 1:
            return top / (1 + top), []
        # Lower case may change the length of a text; its words keep their order.
        places = list(WORD.finditer(text))
        spans: list[dict[str, int]] = []
        if len(places) == len(odds):
            last = -2
            for i, (place, o) in enumerate(zip(places, odds)):
                if o >= 1:
                    if i == last + 1:
                        spans[-1]["end"] = place.end()
                    else:
                        spans.append({"start": place.start(), "end": place.end()})
                    last = i
        return top / (1 + top) if top < 1e15 else 1.0, spans


def score(docs: DataFrame, chain: Chain | None) -> DataFrame:
    """doc_id, score and spans of every document, from its whole text."""
    ship(docs.sparkSession)
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(chain) if chain else None
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [scorer.judge(t) if scorer and t else (0.0, []) for t in texts]
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array([f[0] for f in found], pa.float64()),
                    pa.array([f[1] for f in found], span),
                ],
                names=["doc_id", "score", "spans"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, score double, spans array<struct<start:int,end:int>>"
    )
