import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
import xxhash
from corpus_cases import rows_of
from pyspark.sql import functions as F

from custvalue.llm import listrank, trie

SCHEMA = "conv_id long, turn long, role string, text string, number string, block string, depth string, words string"


@pytest.fixture
def many_ranges(spark):
    """Small ranges are not put together, so orders go over several blocks."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)


def signed(value):
    return value - (1 << 64) if value >= 1 << 63 else value


def hashes(role, text):
    """The order of turns that share a number."""
    def chain(seed, *parts):
        for p in parts:
            seed = xxhash.xxh64_intdigest(p, seed)
        return signed(seed)

    one = xxhash.xxh64_intdigest((1).to_bytes(4, "little"), 42)
    return chain(42, role.encode(), text.encode()), chain(one, text.encode(), role.encode())


def brute(rows):
    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            turns[conv_id].append(((turn is not None, turn or 0), hashes(role, text), (role, text)))
    own = {c: [t[-1] for t in sorted(ts)] for c, ts in turns.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        built[c] = tuple(own.get(base, [])[:h] + ts[h:])
    members = defaultdict(list)
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    found = []
    for node, convs in members.items():
        top = len(node)
        inside = [n for n in members if n[:top] == node]
        saved = sum((len(members[n]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) for n in inside if n)
        ends = ",".join(str(c) for c in sorted(c for c in convs if built[c] == node))
        found.append(
            (
                min(convs),
                top,
                min(members[node[:-1]]) if node else None,
                len(convs),
                len(children[node]),
                sum(not children[n] for n in inside),
                saved,
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(found, key=repr)


def conversations():
    rng = random.Random(9)
    said = ["hello", "hi  there you", "", None, "ok\tthen \x0b yes", "天 é", "bye"]
    rows = []
    for c in [*range(0, 50), 60, 61, 100, 119, -3, -20, -25]:
        for turn in range(rng.randrange(0, 6)):
            rows.append((c, rng.choice([turn, turn, turn, None, 2]), rng.choice(["user", "assistant", None]), rng.choice(said)))
    rows += [rows[3], rows[3], (None, 0, "user", "no id"), (300, 1, "user", "long " * 30_000)]
    # A conversation of very many turns, and many of the same ones.
    rows += [(400, i, "user", f"turn {i % 3}") for i in range(300)]
    for c in range(500, 560):
        rows += [(c, i, "user", f"copy {i}") for i in range(3)]
    return rows


@pytest.mark.parametrize("ruler,walked,depths,block", [(32, 50_000, 4096, 65_536), (3, 20, 7, 10)])
def test_trie_agrees_with_brute_force(spark, many_ranges, monkeypatch, ruler, walked, depths, block):
    monkeypatch.setattr(trie, "list_rank", lambda links: listrank.list_rank(links, ruler, walked))
    named = trie.named
    monkeypatch.setattr(trie, "named", lambda turns: named(turns, depths))
    rows = conversations()
    found = trie.prefix_trie(frame(spark, rows).repartition(5), block)
    want = brute(rows)
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    assert found.columns == names
    assert rows_of(found) == want


def test_no_conversations_and_turnless_ones(spark):
    assert trie.prefix_trie(frame(spark, [])).count() == 0
    assert trie.prefix_trie(frame(spark, [(None, 1, "user", "a")])).count() == 0
    alone = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(alone, 0, "user", "a"), (alone, 1, "user", "b")]
    assert rows_of(trie.prefix_trie(frame(spark, rows))) == brute(rows)
    assert brute(rows)[0][:6] == (alone, 0, None, 1, 0, 1)


@pytest.mark.parametrize("size", [1, 2, 50, 3000])
def test_list_rank(spark, size):
    rng = random.Random(size)
    items = list(range(size))
    rng.shuffle(items)
    links = spark.createDataFrame(list(zip(items, [*items[1:], None])), "item long, next long")
    want = {item: size - 1 - i for i, item in enumerate(items)}
    for ruler, walked in ((8, 100), (8, 4), (10**9, 1)):
        found = listrank.list_rank(links, ruler, walked)
        assert {r["item"]: r["rank"] for r in found.collect()} == want


def test_numbering_and_prefix_sums(spark, many_ranges):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("a"), (F.col("id") % 3).alias("b")).repartition(7)
    found = sorted((r["b"], r["a"], r["number"], r["block"]) for r in listrank.numbered(rows, F.col("b"), F.col("a")).collect())
    assert [r[2] for r in found] == list(range(5000))
    assert len({r[3] for r in found}) > 1
    sums = listrank.prefix_sums(spark.range(1000).selectExpr("id", "id % 7 as v"), "id", "v", block=64)
    total, got = 0, {r["id"]: r["v"] for r in sums.collect()}
    for i in range(1000):
        total += i % 7
        assert got[i] == total


def test_arcs_of_a_large_family_are_made_in_many_tasks(spark, many_ranges):
    """Parents meet their children by block of rows, so a family may be of any size."""
    rows = [(20 * i + 1, 0, "user", f"first {i}") for i in range(400)]
    nodes = trie._linked(trie.prefix_nodes(frame(spark, rows)))
    assert nodes.where("n_children > 80").count() == 1
    assert trie.tour(nodes).count() == 2 * nodes.count()
    assert trie.tour(nodes).where("next is null").count() == 1
