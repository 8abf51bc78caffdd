"""Documents with the cases that every operator has to define a result for."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

#: Columns of the caller whose names the operators use for their own.
CLASHING = (
    "size kept keep_id own_id own_digest going_id copies copy component component_id fp digest slot "
    "range own hashes ids chunk score spans taken target key"
).split()


def words(rng: random.Random, count: int) -> str:
    return " ".join(rng.choice(["the", "of", "and", "thing", "Größe", "été", "niño", "run", "code"]) + rng.choice(["", "s", "er", "ly", ","]) for _ in range(count))


def documents() -> list[tuple]:
    rng = random.Random(5)
    texts = [words(rng, rng.choice([1, 3, 8, 40, 200])) for _ in range(40)]
    texts += [None, "", " \t\n", "!!! 123", "a", "日本語のテキスト" * 5, "x" * 300]
    texts += [words(rng, 9000)]  # very long
    texts += [texts[0], texts[0] + " ", texts[4].upper(), texts[3].replace(" ", "  ")]
    base = words(rng, 300).split(" ")
    for i in range(6):  # near copies
        changed = list(base)
        changed[i * 7] = "changed"
        texts.append(" ".join(changed))
    rows = [
        (i, t, ["en", "de", None][i % 3], [f"s{i % 4}", None][i % 5 == 0], len(t or ""))
        for i, t in enumerate(texts)
    ]
    return rows + [rows[7], rows[7], (None, "no id here", "en", "s1", 10), (None, None, None, None, None)]


def frame(spark, rows=None, clashing=False):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(documents() if rows is None else rows, SCHEMA)
    return df.withColumns({c: F.lit("own") for c in CLASHING}) if clashing else df


def empty(spark):
    return frame(spark, [])


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)
