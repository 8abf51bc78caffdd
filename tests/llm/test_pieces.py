import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from corpus_cases import documents, empty, frame, words
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from custvalue.llm import counts, pieces, segment


@pytest.fixture(scope="module")
def model():
    return pieces.load()


def whole(model, text):
    """One pass over the whole text, without runs, chunks or memory."""
    marked = model.marked(text)
    _, back = model.forward(marked, len(marked), [0.0])
    return model.trace(marked, back, len(marked))[1]


def brute(model, text):
    """Best score over all segmentations, by recursion from the right."""
    marked = model.marked(text)
    best = {len(marked): 0.0}
    for start in range(len(marked) - 1, -1, -1):
        options = []
        for end in range(start + 1, len(marked) + 1):
            score = model.scores.get(marked[start:end])
            if score is None and end == start + 1:
                score = model.unknown
            if score is not None:
                options.append(score + best[end])
        best[start] = max(options)
    return best[0]


def test_pieces_agree_with_the_library_in_unigram_mode(model):
    proto = sentencepiece_model_pb2.ModelProto()
    with open(pieces.MODEL, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = 1
    for piece in proto.pieces:
        # The library adds 32-bit scores; a billion would hide all others.
        piece.score = max(piece.score, -40_000.0)
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    rng = random.Random(2)
    for _ in range(300):
        text = words(rng, rng.randrange(1, 6))
        assert whole(model, text) == library.encode(text)


def test_score_is_the_best_of_all_segmentations(model):
    rng = random.Random(4)
    for _ in range(200):
        text = "".join(rng.choice("aeth éß天▁\n ") for _ in range(rng.randrange(1, 40)))
        marked = model.marked(text)
        assert model.forward(marked, len(marked), [0.0])[0][-1] == brute(model, text)
        ids = whole(model, text)
        assert pieces.load_decoder().decode(np.array(ids), [len(ids)]) == [text.replace(pieces.SPACE, " ").encode()]


def test_sweeps_give_the_pieces_of_single_runs(model):
    rng = random.Random(8)
    texts = [words(rng, 40) for _ in range(50)] + ["", "天天é\x00\U0001F600 ß", "ab" * 40, " " * 70, "x" * 300, "a\n\n\nb"]
    texts += ["".join(rng.choice("abcdetoin天é😀▁ ,.\n") for _ in range(rng.randrange(90))) for _ in range(200)]
    found = [np.frombuffer(f, np.int32).tolist() for f in model.encode([model.marked(t) for t in texts])]
    assert found == [whole(model, t) for t in texts]
    ends = np.cumsum([len(f) for f in found]).tolist()
    decoded = pieces.load_decoder().decode(np.array([i for f in found for i in f], np.int32), ends)
    assert decoded == [t.replace(pieces.SPACE, " ").encode() for t in texts]


def test_memory_of_runs_starts_again_and_changes_nothing(model, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 50)
    monkeypatch.setattr(pieces, "SWEEP", 7)
    rng = random.Random(3)
    for _ in range(40):
        text = words(rng, 30)
        assert np.frombuffer(model.encode([model.marked(text)])[0], np.int32).tolist() == whole(model, text)
    model.forget()


def test_matrices_combine_in_any_grouping(model):
    rng = random.Random(12)
    text = model.marked("".join(rng.choice("aethin ,") for _ in range(600)) + words(rng, 200).replace(" ", ""))
    width, chunk = model.longest, 57
    parts = [
        segment.transfer(model, text[s : s + chunk + width - 1], min(chunk, len(text) - s))
        for s in range(0, len(text), chunk)
    ]
    left = parts[0]
    for m in parts[1:]:
        left = segment.combine(left, m)
    for _ in range(20):
        some = list(parts)
        while len(some) > 1:
            i = rng.randrange(len(some) - 1)
            some[i : i + 2] = [segment.combine(some[i], some[i + 1])]
        assert np.array_equal(some[0], left)


def test_one_pass_carries_all_entries(model):
    rng = random.Random(13)
    for _ in range(30):
        text, own = "".join(rng.choice("aethino") for _ in range(60)), 45
        matrix = segment._all_entries(model, text, own)
        for state in range(model.longest):
            assert np.array_equal(matrix[state], segment._leaving(model, text[state:], own - state))


def chunked(model, text, chunk):
    marked, width = model.marked(text), model.longest
    parts = [
        (marked[s : s + chunk + width - 1], min(chunk, len(marked) - s))
        for s in range(0, len(marked), chunk)
    ]
    scores, entries = np.full(width, pieces.LOW), []
    scores[0] = 0.0
    for text_part, own in parts:
        entries.append(scores)
        scores = (scores[:, None] + segment.transfer(model, text_part, own)).max(axis=0)
    state, found = 0, []
    for (text_part, own), entry in reversed(list(zip(parts, entries))):
        ((shared, states, ends),) = segment.trace_chunks(model, [(text_part, own, entry)])
        found.append([*shared.tolist(), *ends[state]])
        state = states[state]
    return [i for part in reversed(found) for i in part]


@pytest.mark.parametrize("chunk", [17, 40, 101])
def test_chunks_give_the_pieces_of_the_whole(model, chunk):
    rng = random.Random(chunk)
    for k in range(60):
        text = words(rng, 60)
        if k % 3 == 0:
            text = text.replace(" ", "")  # no place where pieces must meet
        if k % 4 == 0:
            text = "".join(rng.choice("ab天é ▁\n") for _ in range(150))
        assert chunked(model, text, chunk) == whole(model, text)


def test_encode_decode_and_count_on_the_hard_cases(spark, model):
    docs = frame(spark, clashing=True).withColumn("row", F.monotonically_increasing_id())
    encoded = segment.encode(docs, ("doc_id", "row", "text"), chunk=100, block=3)
    decoded = segment.decode(encoded.withColumn("n", F.size("ids"))).collect()
    texts = {r["row"]: r["text"] for r in docs.collect()}
    assert len(decoded) == len(texts) == len(documents())
    for r in decoded:
        text = texts[r["row"]] or ""
        assert r["decoded"] == text.replace(pieces.SPACE, " ")
        assert r["n"] == len(whole(model, text))
    encoded = {r["row"]: r["ids"] for r in encoded.collect()}
    assert all(encoded[k] == whole(model, t or "") for k, t in texts.items())
    given = ("ids_sha256", "ids", "decoded_sha256", "n_tokens")
    for r in segment.encode(docs, ("row",), chunk=1000, give=given).collect():
        ids = whole(model, texts[r["row"]] or "")
        assert (r["ids"], r["n_tokens"]) == (ids, len(ids))
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<i4").tobytes()).hexdigest()
        text = (texts[r["row"]] or "").replace(pieces.SPACE, " ")
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    counted = sorted((r["doc_id"] or -1, r["n_tokens"]) for r in counts.token_counts(docs).collect())
    assert counted == sorted((d[0] or -1, len(whole(model, d[1] or ""))) for d in documents())
    for df in (segment.encode(empty(spark)), counts.token_counts(empty(spark))):
        assert df.count() == 0


def test_trie_scores_a_shared_prefix_once(model):
    trie = counts.CountTrie(model)
    trie.count("running runner")
    nodes = len(trie.best)
    assert trie.count("run runn running") == len(whole(model, "run runn running"))
    assert len(trie.best) == nodes
    small = counts.CountTrie(model, nodes=60)
    rng = random.Random(9)
    for _ in range(50):
        text = words(rng, 20) + " " + "y" * rng.randrange(100)
        assert small.count(text) == len(whole(model, text))
