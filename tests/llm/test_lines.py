import random
from collections import defaultdict

from corpus_cases import documents, empty, frame, rows_of
from pyspark.sql import functions as F

from custvalue.llm import lines

BLANKS = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def brute(rows, holders, shortest):
    held = defaultdict(list)
    for number, (doc_id, text, *_) in enumerate(rows):
        for key in {key_of(line) for line in (text or "").split("\n")}:
            if len(key) >= shortest:
                held[key].append(doc_id)
    keeper = {
        key: max((i for i in ids if i is not None), default=None) for key, ids in held.items() if len(ids) >= holders
    }
    found = []
    for doc_id, text, *_ in rows:
        every = (text or "").split("\n")
        left = [line for line in every if keeper.get(key_of(line), doc_id) == doc_id]
        found.append((doc_id, "\n".join(left), len(every), len(every) - len(left)))
    return sorted(found, key=repr)


def line_rows():
    rng = random.Random(3)
    shared = [f"This shared line number {i} has enough Characters é" for i in range(12)] + ["short line", "天" * 40]
    rows = []
    for i in range(120):
        own = [f"an own line of document {i}, place {j}, that no other has" for j in range(rng.randrange(4))]
        own += [rng.choice([" ", "\t", ""]) + rng.choice([s, s.upper()]) + rng.choice(["", "\r"]) for s in rng.choices(shared, k=4)]
        rng.shuffle(own)
        rows.append((rng.choice([i, i, i, 7, None]), "\n".join(own), "en", "s", 1))
    rows += [rows[5], rows[5], rows[6]]
    rows += [(200, "\n".join(own * 3), "en", "s", 1), (201, None, None, None, None), (202, "", "en", "s", 1), (203, "\n\n", "en", "s", 1)]
    rows.append((204, "\n".join(f"a very long text's line {i % 700} of forty code points" for i in range(5000)), "en", "s", 1))
    return rows


def test_lines_agree_with_brute_force(spark):
    rows = line_rows()
    for holders, shortest, batches, full in ((5, 40, 6, 3), (2, 10, 4, 2), (1, 1, 1, 2), (5, 40, 9, 2)):
        docs = frame(spark, rows, clashing=True).repartition(4)
        found = lines.drop_repeated_lines(docs, holders=holders, shortest=shortest, batches=batches, full=full)
        assert rows_of(found) == brute(rows, holders, shortest)
    assert rows_of(lines.drop_repeated_lines(frame(spark))) == brute(documents(), 5, 40)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("line_runs_")]


def test_nothing_to_drop(spark):
    assert lines.drop_repeated_lines(empty(spark)).count() == 0
    rows = [(i, None, "en", "s", 1) for i in range(9)]
    assert {tuple(r)[1:] for r in lines.drop_repeated_lines(frame(spark, rows)).collect()} == {("", 1, 0)}
    rows = [(None, "the same line of forty code points or more", "en", "s", 1) for _ in range(6)]
    assert {r["n_dropped"] for r in lines.drop_repeated_lines(frame(spark, rows)).collect()} == {0}


def test_runs_know_what_is_new_and_are_compacted(spark):
    def batch(*numbers):
        rows = [(i, f"line {n} that is long enough to be looked at, yes", "en", "s", 1) for i, n in numbers]
        return lines.line_keys(frame(spark, rows))

    runs = lines.LineRuns(spark, full=2)
    runs.add(batch((9, 1), (8, 1), (8, 2)))
    runs.add(batch((7, 1), (7, 3)))
    assert runs.compactions == 1 and [n for _, n in runs.levels] == [0, 1]
    runs.add(batch((6, 3), (6, 4), (5, 1)))
    level = spark.table(runs.levels[0][0])
    assert sorted((r["holders"], r["keeper"], r["first"]) for r in level.collect()) == [(1, 5, False), (1, 6, False), (1, 6, True)]
    # A batch meets the runs by merge joins, and only its own rows move.
    found = sorted((r["holders"], r["keeper"]) for r in runs.totals().collect())
    assert found == [(1, 6), (1, 8), (2, 7), (4, 9)]
    plan = runs.totals()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    runs.close()
    assert runs.levels == []


def test_batches_fall_with_doc_id(spark):
    docs = spark.range(1000).withColumnRenamed("id", "doc_id")
    found = docs.withColumn("b", lines._batch_of(docs, 5)).groupBy("b").agg(F.min("doc_id"), F.max("doc_id"), F.count("*"))
    rows = sorted(map(tuple, found.collect()))
    assert [r[0] for r in rows] == [0, 1, 2, 3, 4]
    assert all(high[1] > low[2] for high, low in zip(rows, rows[1:]))
    assert all(150 <= r[3] <= 250 for r in rows)
