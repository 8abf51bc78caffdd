import itertools
import math
import random

import numpy as np
from corpus_cases import documents, empty, frame

from custvalue.llm import toxicity
from custvalue.llm.common import table

LABELS = "doc_id long, quality int, toxic int"


def test_odds_agree_with_all_paths():
    rng = random.Random(6)
    chain = toxicity.Chain(np.zeros(1), 0.0, np.array([[0.3, -0.7], [-0.2, 0.9]]))
    for size in range(1, 7):
        e = [rng.uniform(-2, 2) for _ in range(size)]
        weight = [[0.0, 0.0] for _ in range(size)]
        for path in itertools.product((0, 1), repeat=size):
            w = math.exp(
                sum(x for x, s in zip(e, path) if s)
                + sum(chain.moves[a, b] for a, b in zip(path, path[1:]))
            )
            for t, s in enumerate(path):
                weight[t][s] += w
        want = [b / a for a, b in weight]
        assert np.allclose(chain.odds([math.exp(x) for x in e]), want)
    assert chain.odds([]) == []


def test_fit_learns_words_starts_and_context():
    rng = random.Random(2)
    rows, flags = [], []
    for _ in range(400):
        words = [rng.choice("the of and run code thing".split()) for _ in range(11)]
        labels = [0] * 11
        if rng.random() < 0.5:
            place = rng.randrange(11)
            words[place] = rng.choice(["idiot", "badly" + rng.choice("abcde")])
            labels[place] = 1
        if rng.random() < 0.3:
            words[0], labels[0] = None, 0
        rows.append(words)
        flags.append(labels)
    chain = toxicity.fit_chain(rows, np.array(flags))
    scorer = toxicity._Scorer(chain)
    assert scorer.judge("the code and the idiot of code")[0] > 0.9
    assert scorer.judge("the code badlyz thing")[0] > 0.7  # an unseen word with a known start
    assert scorer.judge("the code and the thing of code")[0] < 0.3
    text = "The code,  Idiot! and run"
    score, spans = scorer.judge(text)
    assert [text[s["start"] : s["end"]] for s in spans] == ["Idiot"]


def test_hard_cases(spark):
    docs = frame(spark, clashing=True)
    none = spark.createDataFrame([(1, 1, 0), (2, None, None), (None, 1, 1), (999, 1, 1)], LABELS)
    assert toxicity.fit(docs, none) is None
    assert {r["score"] for r in toxicity.score(docs, None).collect()} == {0.0}
    rows = [(i, ("nice words here " * 3) + ("scum " if i % 3 == 0 else "") + f"end{i}", "en", "s", 1) for i in range(120)]
    labels = [(i, 1, int(i % 3 == 0)) for i in range(120)] + [(0, 1, 0), (0, 1, None)]
    chain = toxicity.fit(frame(spark, rows), spark.createDataFrame(labels, LABELS))
    found = toxicity.score(docs, chain).collect()
    assert len(found) == len(documents())
    assert all(0 <= r["score"] < 0.7 for r in found)
    own = {r["doc_id"]: r for r in toxicity.score(frame(spark, rows), chain).collect()}
    assert all((own[i]["score"] >= 0.7) == (i % 3 == 0) for i in range(120))
    assert toxicity.score(empty(spark), chain).count() == 0


def test_copies_do_not_speak_for_their_other_words(spark):
    rows = [(i, f"one very own unusual sentence stands here idiot number {i}" if i < 60 else f"plain number {i} and more", "en", "s", 1) for i in range(400)]
    rows += [(1000 + i, f"plain number {i} idiot {i + 1} and more", "en", "s", 1) for i in range(60)]
    labels = [(r[0], 1, int("idiot" in r[1])) for r in rows]
    joined = frame(spark, rows).join(spark.createDataFrame(labels, LABELS), "doc_id").select("text", "toxic")
    assert toxicity.lexicon(joined) == {"=idiot", "^idi", "^idio"}


def test_windows_lie_in_all_parts_of_a_text():
    import pyarrow as pa

    text = " ".join(["scum" if i % 40 == 39 else f"w{i}" for i in range(8000)])
    batch = pa.record_batch([pa.array([text, "only w1 here"]), pa.array([1, 0])], names=["text", "toxic"])
    (found,) = toxicity._windows({"=scum"})([batch])
    rows = found.to_pylist()
    centers = [r["words"][toxicity.SIDE] for r in rows]
    marked = [r for r, c in zip(rows, centers) if c == "scum"]
    assert len(marked) == toxicity.MARKED and all(r["flags"][toxicity.SIDE] == 1 for r in marked)
    places = sorted(int(r["words"][toxicity.SIDE - 1][1:]) for r in marked)
    assert places[0] < 3000 and places[-1] > 5000
    assert len(rows) == toxicity.MARKED + toxicity.WINDOWS + 3
    assert found.to_pylist() == next(iter(toxicity._windows({"=scum"})([batch]))).to_pylist()


def test_held_out_quality(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    from custvalue.llm.language import held_out

    held = held_out(3, 1)
    chain = toxicity.fit(docs.where(~held), labels.where(~held))
    rows = toxicity.score(docs.where(held), chain).join(labels, "doc_id").collect()
    toxic = [r["score"] >= 0.7 for r in rows if r["toxic"] == 1]
    clean = [r["score"] >= 0.7 for r in rows if r["toxic"] == 0]
    assert sum(toxic) >= 0.9 * len(toxic) > 0
    assert sum(clean) <= 0.02 * len(clean)
