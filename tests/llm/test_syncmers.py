import hashlib
import random
import re

import xxhash
from corpus_cases import documents, empty, frame

from custvalue.llm import queries, syncmers
from custvalue.llm.common import settle


def h64(*numbers, seed=42):
    """Spark's hash of longs: each one's hash is the next one's seed."""
    for n in numbers:
        seed = xxhash.xxh64_intdigest((n & (2**64 - 1)).to_bytes(8, "little"), seed)
    return seed - (1 << 64) if seed >= 1 << 63 else seed


def slow_anchors(text):
    text = re.sub("([⺀-\U0010ffff])", r" \1 ", text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    hashes = [h - (1 << 64) if h >= 1 << 63 else h for h in hashes]
    pairs = [h64(a, b) for a, b in zip(hashes, hashes[1:])]
    found = [
        (i, (h64(pairs[i], pairs[i + 2], pairs[i + 3]) & (2**64 - 1)) >> 32)
        for i in range(len(words) - 4)
        if min(pairs[i], pairs[i + 3]) <= min(pairs[i + 1], pairs[i + 2])
    ]
    return hashes, found


def slow_print(text):
    hashes, found = slow_anchors(text)
    if not hashes:
        return []
    return sorted({h for _, h in found})[:64] or [(h64(*hashes) & (2**64 - 1)) >> 32]


def slow_likeness(a, b):
    if not a and not b:
        return 1.0
    smallest = sorted({*a, *b})[:64]
    return len({*smallest} & {*a} & {*b}) / len(smallest)


def in_order(rows):
    """By doc_id, null first, and hash of the text."""
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, h64_of(r[1] or ""), r[1] or ""))


def test_fingerprints_and_edits_agree_with_brute_force(spark):
    rows = in_order(documents())
    want = []
    for i, row in enumerate(rows):
        text, after = row[1] or "", rows[i - 1][1] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        a, b, c = slow_print(text), slow_print(edited), slow_print(after)
        sha = hashlib.sha256(edited.encode()).hexdigest()
        strings = ["".join(f"{h:08x}" for h in x) for x in (a, b)]
        want.append((row[0], len(text), sha, *strings, slow_likeness(a, b), slow_likeness(a, c)))
    got = [tuple(r) for r in syncmers.edit_likeness(frame(spark, clashing=True)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_single_row_and_empty_table(spark):
    one = syncmers.edit_likeness(frame(spark, [(7, "a b c d e f", "en", "s", 11)])).collect()
    assert [(r["doc_id"], r["near_next"]) for r in one] == [(7, 1.0)]
    assert syncmers.edit_likeness(empty(spark)).count() == 0


def test_positions_of_anchors(spark):
    rows = [r for r in documents() if r[0] is not None and r[0] < 50]
    found = settle(syncmers.positions(frame(spark, rows)), "positions").collect()
    want = [(r[0], i, h) for r in rows for i, h in slow_anchors(r[1])[1]]
    assert sorted(map(tuple, found)) == sorted(want)


def whole_anchors(text):
    """Position and 64-bit hash of every anchor."""
    hashes = [h64_of(w) for w in text.split()]
    pairs = [h64(a, b) for a, b in zip(hashes, hashes[1:])]
    return [(i, h64(pairs[i], pairs[i + 2], pairs[i + 3])) for i, _ in slow_anchors(text)[1]]


def h64_of(word):
    h = xxhash.xxh64_intdigest(word.encode(), 42)
    return h - (1 << 64) if h >= 1 << 63 else h


def test_query_compares_whole_sets_and_places_passages(spark, tmp_path):
    rng = random.Random(4)
    long, other = ([f"w{rng.randrange(5000)}" for _ in range(6000)] for _ in range(2))
    changed = long[:3000] + ["changed"] + long[3001:]
    quoting = other[:1000] + long[4000:4060] + other[1000:]
    texts = {i: " ".join(t) for i, t in enumerate((long, changed, quoting))}
    frame(spark, [(i, t, "en", "s", 1) for i, t in texts.items()]).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r for r in settle(queries.op7_document_fingerprints(spark, str(tmp_path)), "whole").collect()}
    anchors = {i: whole_anchors(t) for i, t in texts.items()}
    sets = {i: {h for _, h in a} for i, a in anchors.items()}
    for i, row in found.items():
        assert [tuple(p) for p in row["positions"]] == anchors[i]
        assert row["fingerprint"] == "".join(f"{h & (2**64 - 1):016x}" for h in sorted(sets[i]))
    for i, after in ((1, 0), (2, 1)):
        assert found[i]["near_next"] == len(sets[i] & sets[after]) / len(sets[i] | sets[after])
    assert 0.99 < found[1]["near_next"] < 1 and 0 < found[2]["near_next"]
    at = {h: p for p, h in anchors[0]}
    apart = [at[h] - p for p, h in map(tuple, found[2]["positions"]) if h in at]
    assert apart.count(3000) >= 15


def whole_set(text):
    """Every distinct 64-bit anchor hash in order; of a text without one that of all its words."""
    text = re.sub("([⺀-\U0010ffff])", r" \1 ", text or "")
    words = [h64_of(w) for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    pairs = [h64(a, b) for a, b in zip(words, words[1:])]
    found = {
        h64(pairs[i], pairs[i + 2], pairs[i + 3])
        for i in range(len(words) - 4)
        if min(pairs[i], pairs[i + 3]) <= min(pairs[i + 1], pairs[i + 2])
    }
    return found or ({h64(*words)} if words else set())


def test_query_agrees_with_brute_force_on_the_hard_cases(spark, tmp_path):
    frame(spark, clashing=True).write.parquet(f"{tmp_path}/documents.parquet")
    rows = in_order(documents())
    want = []
    for i, row in enumerate(rows):
        text, after = row[1] or "", rows[i - 1][1] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        a, b, c = whole_set(text), whole_set(edited), whole_set(after)
        prints = ["".join(f"{h & (2**64 - 1):016x}" for h in sorted(x)) for x in (a, b)]
        like = [len(a & x) / len(a | x) if a | x else 1.0 for x in (b, c)]
        want.append((row[0], len(text), hashlib.sha256(edited.encode()).hexdigest(), *prints, *like))
    found = queries.op7_document_fingerprints(spark, str(tmp_path)).drop("positions").collect()
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)


def test_rows_of_one_id_are_dealt_over_ranges(spark):
    """A third of the rows share a doc_id, a third have none; copies among both."""
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(900)}" for _ in range(12)) for _ in range(900)]
    rows = [(7 if i % 3 else i, t, "en", "s", 1) for i, t in enumerate(texts)]
    rows = [(None, *r[1:]) if i % 3 == 1 else r for i, r in enumerate(rows)]
    rows += [(7, texts[2], "en", "s", 1)] * 40 + [(None, texts[1], "en", "s", 1)] * 40
    docs = frame(spark, rows)
    dealt = syncmers._by_range(docs.select("doc_id", "text")).groupBy("range", "slice")
    assert max(r["count"] for r in dealt.count().collect()) < 120
    want, ordered = [], in_order(rows)
    for i, row in enumerate(ordered):
        cut = len(row[1]) // 3
        edited = row[1][: len(row[1]) - cut] + ordered[i - 1][1][:cut]
        want.append((row[0], hashlib.sha256(edited.encode()).hexdigest()))
    found = syncmers.edit_likeness(docs, None).select("doc_id", "edited_sha256").collect()
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)
