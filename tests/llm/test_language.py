import base64
import random
from collections import Counter
from statistics import median

from corpus_cases import documents, empty, frame

import corpus_pipeline
from custvalue.llm import language
from custvalue.llm.common import table


def code(gram):
    number = 0
    for character in gram:
        number = number << 21 | ord(character)
    return number


def slow_grams(text):
    found = Counter()
    letters = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    for word in letters.split():
        padded = f" {word} "
        for n in (1, 2, 3):
            for i in range(len(padded) - n + 1):
                if padded[i : i + n] != " ":
                    found[code(padded[i : i + n])] += 1
    return found


def slow_profile(counts):
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:300]]


def slow_judge(text, learned):
    own = slow_profile(slow_grams(text))
    if not own or not learned:
        return "und", 0.0
    total = {
        lang: sum(abs(i - p.index(g)) if g in p else 300 for i, g in enumerate(own))
        for lang, p in learned.items()
    }
    best = min(sorted(total), key=total.get)
    return best, 1 - total[best] / (300 * len(own))


def test_profiles_and_verdicts_agree_with_brute_force(spark):
    docs, by_lang = frame(spark, clashing=True), {}
    for _, text, lang, *_ in documents():
        if lang and text is not None:
            by_lang.setdefault(lang, Counter()).update(slow_grams(text))
    learned = language.profiles(docs)
    assert learned == {lang: slow_profile(c) for lang, c in by_lang.items()}
    want = [(d, *slow_judge(t, learned)) for d, t, *_ in documents()]
    got = [tuple(r) for r in language.identify(docs, learned).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    kept = language.keep_identified(docs, learned)
    assert kept.columns == docs.columns
    assert kept.count() == sum(w[1] != "und" and w[2] >= 0.05 for w in want)


def test_nothing_learned_and_empty_tables(spark):
    assert language.profiles(empty(spark)) == {}
    found = language.identify(frame(spark), {}).collect()
    assert {(r["lang_pred"], r["score"]) for r in found} == {("und", 0.0)}
    assert language.identify(empty(spark), {"en": [97]}).count() == 0


def test_blocks_of_a_long_text_add_up(monkeypatch):
    text = " ".join(str(d[1]) for d in documents()) + "é ß" * 50
    want = slow_grams(text)
    for block in (7, 1000, 1 << 20):
        monkeypatch.setattr(language, "BLOCK", block)
        keys, counts = language.gram_counts(text)
        assert dict(zip(keys.tolist(), counts.tolist())) == dict(want)


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    held = language.held_out(4, 2)
    found = language.identify(docs.where(held), language.profiles(docs.where(~held)))
    rows = found.join(docs.select("doc_id", "lang"), "doc_id").where("lang is not null").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.98 * len(rows) > 0


POLISH = """Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni
obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa. Każdy człowiek
posiada wszystkie prawa i wolności zawarte w niniejszej Deklaracji bez względu na różnice."""


def test_texts_unlike_every_language_go_and_others_stay(spark):
    rng = random.Random(3)
    planted = [POLISH, " ".join(POLISH.split()[:12])]
    for _ in range(20):
        spelled = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(60)]
        planted += [" ".join(spelled), base64.b64encode(rng.randbytes(300)).decode()]
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text", "lang", "source", "n_chars")
    # Some of them even claim a language.
    rows = [(-1 - i, t, [None, "en"][i % 2], "s", len(t)) for i, t in enumerate(planted)]
    kept = corpus_pipeline.identify_language(spark, docs.unionByName(frame(spark, rows)), "")
    want = {r["doc_id"] for r in docs.collect() if slow_grams(r["text"])}
    assert {r["doc_id"] for r in kept.collect()} == want


def test_limits_agree_with_brute_force(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    learned, by_class = language.profiles(docs), {}
    for r in docs.where("text is not null and lang is not null").collect():
        lang, score = slow_judge(r["text"], learned)
        grams = (min(300, len(slow_grams(r["text"]))) - 1).bit_length()
        for at in ((lang, grams), (lang, None)):
            by_class.setdefault(at, []).append(int(score * 10_000))
    want = {at: 0.45 * median(s) / 10_000 for at, s in by_class.items() if len(s) >= 50}
    assert want and language.limits(docs, learned) == want
