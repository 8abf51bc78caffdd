import hashlib
import random
import re
from collections import defaultdict

from corpus_cases import CLASHING, documents, empty, frame, rows_of

from custvalue.llm import exact
from custvalue.llm.common import settle
from custvalue.llm.cuckoo import CuckooIndex


def digest(n: int) -> bytes:
    return hashlib.sha256(str(n).encode()).digest()


def test_index_holds_what_was_inserted_and_not_deleted():
    rng, live, index = random.Random(3), set(), CuckooIndex(2)
    for _ in range(20_000):
        d = digest(rng.randrange(3000))
        if rng.random() < 0.6:
            assert index.insert(d) == (d not in live)
            live.add(d)
        else:
            assert index.delete(d) == (d in live)
            live.discard(d)
    assert set(index) == live and len(index) == len(live)
    assert all((digest(n) in index) == (digest(n) in live) for n in range(4000))
    assert index.resizes >= 5


def test_values_move_with_their_digests():
    rng, live, index = random.Random(6), {}, CuckooIndex(2)
    for n in range(5000):
        d = digest(rng.randrange(4000))
        if index.insert(d, [n]):
            live[d] = [n]
        elif rng.random() < 0.3:
            index.delete(d)
            del live[d]
    assert dict(index.items()) == live
    assert index.get(digest(-1)) is None


def test_equal_fingerprints_and_buckets_overflow_into_a_larger_table():
    # Digests that differ only where the filter does not look share both buckets.
    same = [digest(1)[:24] + n.to_bytes(8, "big") for n in range(8)]
    index = CuckooIndex(2)
    assert all(index.insert(d) for d in same)
    assert all(d in index for d in same)
    assert same[0][:-1] + b"x" not in index
    assert index.false_hits > 0


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        t = text or ""
        groups[re.sub(r"[\x20\x09-\x0D]", "", t)].append((-len(t), doc_id is None, doc_id))
    found = []
    for doc_id, text, *_ in rows:
        t = text or ""
        norm = re.sub(r"[\x20\x09-\x0D]", "", t)
        best = min(groups[norm], key=lambda g: (g[0], g[1], g[2] or 0))
        kept = doc_id == best[2] and -len(t) == best[0]
        sha = hashlib.sha256(norm.encode()).hexdigest()
        found.append((doc_id, best[2], len(groups[norm]), kept, sha))
    return sorted(found, key=repr)


def test_groups_agree_with_brute_force(spark):
    assert rows_of(exact.exact_groups(frame(spark, clashing=True))) == brute(documents())
    assert exact.exact_groups(empty(spark)).count() == 0
    far = [(i, t, "en", "s", 1) for i in (-(1 << 63), (1 << 63) - 1, 0, None) for t in ("x y", "xy", "z")]
    assert rows_of(exact.exact_groups(frame(spark, far))) == brute(far)


def test_survivors_are_the_kept_rows_once(spark):
    docs = frame(spark, clashing=True)
    found = exact.drop_copies(docs)
    assert found.columns == docs.columns
    kept = {(r[0], r[4]) for r in brute(documents()) if r[3]}
    got = [
        (r["doc_id"], hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", r["text"] or "").encode()).hexdigest())
        for r in found.collect()
    ]
    assert sorted(got, key=repr) == sorted(kept, key=repr)
    assert exact.drop_copies(empty(spark)).count() == 0
    assert set(CLASHING) <= set(found.columns)


def test_index_is_updated_and_deleted_from(spark):
    rows = documents()
    index = settle(exact.update(exact.digests(frame(spark, rows[:30]))), "index")
    gone = exact.digests(frame(spark, rows[:3])).select("text_sha256")
    index = exact.update(exact.digests(frame(spark, rows[30:])), index, gone)
    dropped = {r["text_sha256"] for r in gone.collect()}
    want = {(r[4], r[1], r[2]) for r in brute(rows) if r[4] not in dropped}
    got = {(r["digest"].hex(), r["holder"], r["members"]) for r in index.collect()}
    assert got == want
