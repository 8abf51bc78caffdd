import random
import re

import duckdb
import pytest
from corpus_cases import documents, empty, frame, rows_of

from custvalue.llm import mix, oracles


def duck(rows):
    import pandas as pd

    documents_table = pd.DataFrame(rows, columns="doc_id text lang source n_chars".split())
    documents_table["doc_id"] = documents_table["doc_id"].astype("Int64")
    con = duckdb.connect()
    con.register("documents", documents_table)
    rel = con.sql(oracles.STATEMENTS["op1_mix_sources"])
    return sorted(rel.project("doc_id, source, size, source_size, target, taken").fetchall(), key=repr)


def test_mix_agrees_with_sql_on_the_hard_cases(spark):
    assert rows_of(mix.mix(frame(spark, clashing=True))) == duck(documents())
    assert mix.mix(empty(spark)).count() == 0


def test_targets_and_limits(spark):
    rows = [(i, "w " * (1 + i % 50), "en", f"s{i % 7}", 0) for i in range(3000)]
    found = mix.mix(frame(spark, rows)).collect()
    by_source = {r["source"]: r for r in found}
    total = sum(r["size"] for r in found)
    assert sum(r["target"] for r in by_source.values()) == pytest.approx(1.5 * total)
    assert all(r["taken"] <= 2 * r["size"] for r in found)
    for source, r in by_source.items():
        assert r["target"] <= 2 * r["source_size"]
        taken = sum(x["taken"] for x in found if x["source"] == source)
        assert abs(taken - r["target"]) <= 60
    assert rows_of(mix.mix(frame(spark, rows).repartition(5))) == sorted(map(tuple, found), key=repr)


def test_nothing_to_take(spark):
    rows = [(1, None, "en", "a", 0), (2, " ", "en", None, 0)]
    assert [r["taken"] for r in mix.mix(frame(spark, rows)).collect()] == [0, 0]
    assert mix.apply_mix(frame(spark, rows)).count() == 0


def test_documents_of_the_mix(spark):
    docs = frame(spark, clashing=True)
    found = mix.apply_mix(docs)
    assert found.columns == docs.columns
    want = {}
    for r in mix.mix(docs).collect():
        key = (r["doc_id"], r["source"], r["size"])
        want[key] = want.get(key, 0) + r["taken"]
    got = {}
    for r in found.collect():
        size = len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
        key = (r["doc_id"], r["source"], size)
        got[key] = got.get(key, 0) + size
    assert got == {k: v for k, v in want.items() if v}


def test_rows_of_one_id_are_taken_within_the_budget(spark):
    rng = random.Random(2)
    rows = [(7, " ".join("w" * rng.randrange(1, 30)), "en", "s", 1) for _ in range(60)]
    rows += [(8, "the same words", "en", "s", 1)] * 9 + [(None, f"some {'more ' * (i % 5)}words", "en", None, 1) for i in range(20)]
    docs = frame(spark, rows)
    taken = sum(r["taken"] for r in mix.mix(docs).collect())
    assert sum(len(r["text"].split()) for r in mix.apply_mix(docs).collect()) == taken


def test_rows_of_one_id_are_dealt_over_slots(spark):
    rows = [(None if i % 2 else 5, f"text {'and ' * (i % 9)}{i}", "en", "s", 1) for i in range(600)]
    docs = frame(spark, rows)
    slots = docs.select(mix.shuffle_key("mix").substr(1, mix.SLOT_DIGITS).alias("slot")).groupBy("slot").count()
    assert max(r["count"] for r in slots.collect()) < 10
    assert rows_of(mix.mix(docs)) == duck(rows)
