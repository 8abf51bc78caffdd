import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
from corpus_cases import documents, empty, frame, rows_of

from custvalue.llm import search
from custvalue.llm.common import settle, table

ITEMS = "item_id long, text string, rank string, score string, doc_id string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    counted = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    counted = [(d, c) for d, c in counted if c]
    n_docs, length = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    found = []
    for item_id, text in items:
        asked, scored = Counter(terms(text)), []
        for doc_id, c in counted:
            m = 75 + (25 * c.total() * n_docs) // length
            score = sum(
                times
                * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m))
                for t, times in asked.items()
                if t in c
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        found += [(item_id, i, r[3], -r[0]) for i, r in enumerate(sorted(scored)[:k], 1)]
    return sorted(found, key=repr)


def items_frame(spark, items):
    return spark.createDataFrame([(*i, "x", "x", "x") for i in items], ITEMS)


def test_terms_are_those_of_the_pattern():
    rng = random.Random(1)
    alphabet = [chr(c) for c in range(128)] + list("éßÀ天😀\u0085 ")
    for _ in range(300):
        text = "".join(rng.choice(alphabet) for _ in range(60))
        assert [t.decode() for t in search.terms_of(text.encode())] == terms(text)


def test_hard_cases_agree_with_brute_force(spark):
    docs = [(d[0], d[1]) for d in documents()]
    items = [(1, "the Größe été code"), (1, "niño niño RUN"), (None, "thing 123"), (4, None), (5, "..."), (6, "absentterm")]
    items += [(7, "日本語のテキスト" * 5), (8, "the " * 200 + "of"), (9, "absentterm id here")]
    for k in (1, 3, 20):
        found = search.search(frame(spark, clashing=True), items_frame(spark, items), k)
        assert found.columns == ["item_id", "rank", "doc_id", "score"]
        assert rows_of(found) == brute(docs, items, k)


def test_copies_ties_and_many_rounds(spark, monkeypatch):
    monkeypatch.setattr(search, "FIRST", 1)
    monkeypatch.setattr(search, "HELD", 50)
    monkeypatch.setattr(search, "LEAST_SIZE", 16)
    monkeypatch.setattr(search, "SPARSE", 1)
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([2, 5, 30]))), "en", "s", 1) for i in range(200)]
    rows += [(1000 - i, "w1 w2 w3 copied", "en", "s", 1) for i in range(150)]
    items = [(i, " ".join(rng.choices(vocabulary, k=8))) for i in range(12)] + [(50, "w1 w2 w3 copied")]
    found = search.search(frame(spark, rows).repartition(5), items_frame(spark, items), 7)
    assert rows_of(found) == brute([r[:2] for r in rows], items, 7)


def test_blocks_of_items_are_ranked_alike(spark, monkeypatch):
    docs, items = frame(spark), [(i, f"the code {w}") for i, w in enumerate("of and thing run".split())]
    whole = rows_of(search.search(docs, items_frame(spark, items)))
    monkeypatch.setattr(search, "BLOCK_ENTRIES", 4)
    monkeypatch.setattr(search, "BLOCK_ITEMS", 2)
    assert rows_of(search.search(docs, items_frame(spark, items))) == whole


def test_nothing_to_search(spark):
    items = items_frame(spark, [(1, "the")])
    assert search.search(empty(spark), items).count() == 0
    assert search.search(frame(spark, [(1, " .", "en", "s", 1)]), items).count() == 0
    assert search.search(frame(spark), items.limit(0)).count() == 0


def test_bounds_are_never_below_the_score():
    rng = random.Random(7)
    weights = search.Weights(1000, 50_000)
    for size in (3, 40, 3000):
        counts = Counter(f"t{rng.randrange(size)}".encode() for _ in range(size * 2))
        m = weights.length(counts.total())
        tf = np.array(list(counts.values()))
        sketch = search.fold([crc32(t) for t in counts], weights.impact(tf, m), 64)
        at, units = search.unfold(sketch)
        assert len(set(at.tolist())) == len(at) <= 64 and units.min() > 0
        asked = [{f"t{rng.randrange(size * 2)}".encode(): rng.randrange(9000) for _ in range(6)} for _ in range(50)]
        block = search.Block(list(range(50)), asked)
        ((rows, bounds),) = block.bounds([64], [sketch])
        for bound, terms_ in zip(bounds[0], asked):
            score = sum(w * weights.impact(counts[t], m) for t, w in terms_.items() if t in counts)
            assert score <= bound


def test_few_documents_reach_the_threshold(spark):
    """The sketches spare nearly all texts the exact score."""
    docs, items = (table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "benchmark"))
    docs = docs.select("doc_id", "text")
    stats = settle(search.statistics(docs), "terms")
    total = stats.where("term is null").first()
    weights = search.Weights(total["documents"], total["terms"])
    index = settle(search.sketches(docs, weights), "index")
    (block,) = search._blocks(items, stats, weights)
    top = settle(search._first(search.highest_bounds(index, block, 20), 20, "bound").drop("rank"), "top")
    best = search._search_block(docs, index, block, weights, 20).where("rank = 20").collect()
    least = {r["item"]: r["score"] for r in best}
    reaching = search.bounds_from(index, block, [least.get(i, 1) for i in range(len(block.weights))], 20)
    assert top.count() == 20 * len(block.weights)
    assert reaching.count() < 0.01 * docs.count() * len(block.weights)
