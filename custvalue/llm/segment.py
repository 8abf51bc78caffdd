"""Encoding into pieces and decoding, with giant documents cut into chunks.

The best segmentation is a longest path, so a chunk is a matrix over (max, +): entry states are
how far a piece of the chunk before reaches in, exit states how far one reaches out. The product
of such matrices is associative: the matrices of a block of neighbouring chunks are combined into
one, all blocks of a document at once; the few block matrices are scanned, which gives the scores
that enter each block; and these are pushed down through the block to its chunks. With the scores
that enter it, each chunk is traced back on its own, for every exit state, and the states are
linked from the right. Chunks are dealt over tasks; a block of them meets as matrices (2 kB each).

Documents below the chunk size are one chunk with one entry and one exit state: their matrix is a
number, and no scan is needed. Their runs are segmented together, a batch of documents at a time.

Defined cases: a null or empty text has no pieces and decodes to the empty text; a space mark in
a text decodes to a space; repeated rows are encoded each; other columns are carried along
under their names if listed in ``keep``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custvalue.llm import pieces
from custvalue.llm.common import settle, ship, text_of

#: Characters of a chunk; longer documents are encoded by several tasks.
CHUNK = 32768
#: Chunks whose matrices are combined into one.
BLOCK = 32
#: Rows, and chunks, that a task works on together.
BATCH, TRACED = 400, 64


def _meeting_places(model: pieces.PieceModel, text: str, own: int) -> tuple[int, int] | None:
    """First and last place inside the chunk where all paths meet, if there are two.

    Paths meet between characters that are neighbours in no piece.
    """
    joined = model.joined
    first = next((i for i in range(1, own) if text[i - 1 : i + 1] not in joined), None)
    if first is None:
        return None
    last = next(i for i in range(own - 1, 0, -1) if text[i - 1 : i + 1] not in joined)
    return (first, last) if first < last else None


def _leaving(model: pieces.PieceModel, text: str, own: int) -> np.ndarray:
    """Best scores of the exit states from the start of ``text``."""
    leave = np.full(model.longest, pieces.LOW)
    tail = model.forward(text, own, [0.0])[0][own:][: model.longest]
    leave[: len(tail)] = tail
    return leave


def _all_entries(model: pieces.PieceModel, text: str, own: int) -> np.ndarray:
    """The matrix of a chunk where no paths must meet: one pass that carries a row of scores, one
    for each entry state, at every place."""
    width, size, tree = model.longest, len(text), model.tree
    best = np.full((size + 1, width), pieces.LOW)
    for state in range(min(width, own)):
        best[state, state] = 0.0
    for start in range(own):
        base = best[start]
        node, end = tree.get(text[start]), start + 1
        if node is None or node[1] is None:
            np.maximum(best[end], base + model.unknown, out=best[end])
        while node is not None:
            further, score = node
            if score is not None:
                np.maximum(best[end], base + score, out=best[end])
            if end == size:
                break
            node = further.get(text[end])
            end += 1
    matrix = np.full((width, width), pieces.LOW)
    exits = best[own:][:width]
    matrix[:, : len(exits)] = exits.T
    return matrix


def transfer(model: pieces.PieceModel, text: str, own: int) -> np.ndarray:
    """Matrix of a chunk: best score from each entry to each exit state.

    ``text`` runs ``model.longest - 1`` characters beyond the ``own`` ones where the document
    does. If the chunk has places that no piece spans, all paths meet there; the matrix is an
    outer sum of the scores before the first and after the last of them, and leaves out what
    lies between, which adds the same to every path.
    """
    width = model.longest
    places = _meeting_places(model, text, own)
    if places is None:
        return _all_entries(model, text, own)
    matrix = np.full((width, width), pieces.LOW)
    first, last = places
    leave = _leaving(model, text[last:], own - last)
    for state in range(min(width, first + 1)):
        head = text[state:first]
        matrix[state] = model.forward(head, len(head), [0.0])[0][-1] + leave
    return matrix


def combine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The matrix of two neighbours: product over (max, +), associative."""
    return (left[:, :, None] + right[None, :, :]).max(axis=1)


Trace = tuple[np.ndarray, list[int], list[list[int]]]


def trace_chunks(model: pieces.PieceModel, chunks: list[tuple[str, int, np.ndarray]]) -> list[Trace]:
    """For each chunk (text, own characters, scores that enter): ids shared by the paths to all
    exit states, then entry state and further ids of each.

    Where paths meet inside the chunk, only what lies before the first and after the last
    meeting place depends on the states; what lies between is segmented for all chunks together.
    """
    places = [_meeting_places(model, text, own) for text, own, _ in chunks]
    middles = iter(model.encode([c[0][p[0] : p[1]] for c, p in zip(chunks, places) if p]))
    found = []
    for (text, own, entry), place in zip(chunks, places):
        if place is None:
            found.append(_trace_states(model, text, own, entry.tolist()))
            continue
        first, last = place
        _, back = model.forward(text[:first], first, entry.tolist())
        state, head = model.trace(text[:first], back, first)
        shared, states, ends = _trace_states(model, text[last:], own - last, [0.0])
        ids = np.concatenate([head, np.frombuffer(next(middles), np.int32), shared]).astype(np.int32)
        found.append((ids, [state if s >= 0 else -1 for s in states], ends))
    return found


def _trace_states(model: pieces.PieceModel, text: str, own: int, entry: list[float]) -> Trace:
    best, back = model.forward(text, own, entry)
    states, paths = [], []
    for exit_state in range(model.longest):
        end = own + exit_state
        live = end < len(best) and best[end] > pieces.LOW
        state, ids = model.trace(text, back, end) if live else (-1, [])
        states.append(state)
        paths.append(ids)
    live = [p for p, s in zip(paths, states) if s >= 0]
    low, high = min(live), max(live)
    same = next((i for i, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))
    return np.array(low[:same], np.int32), states, [p[same:] for p in paths]


class Tokens:
    """What is given of a batch of encoded texts: the ids, how many, and hashes.

    ``ids_sha256`` is that of the ids as 32-bit numbers, lowest byte first; ``decoded_sha256``
    that of the text which they decode to.
    """

    FIELDS = {
        "ids": (T.ArrayType(T.IntegerType()), pa.list_(pa.int32())),
        "n_tokens": (T.LongType(), pa.int64()),
        "ids_sha256": (T.StringType(), pa.string()),
        "decoded_sha256": (T.StringType(), pa.string()),
    }

    def __init__(self, wanted: tuple[str, ...]):
        self.wanted = wanted
        self.fields = [T.StructField(w, self.FIELDS[w][0]) for w in wanted]

    def columns(self, found: list[bytes], path: str) -> list[pa.Array]:
        data = b"".join(found)
        ends = np.cumsum([len(f) // 4 for f in found], dtype=np.int64)
        given = []
        for name in self.wanted:
            if name == "ids":
                values = pa.Array.from_buffers(pa.int32(), len(data) // 4, [None, pa.py_buffer(data)])
                offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                given.append(pa.ListArray.from_arrays(offsets, values))
                continue
            if name == "n_tokens":
                values = [len(f) // 4 for f in found]
            elif name == "ids_sha256":
                values = [hashlib.sha256(f).hexdigest() for f in found]
            else:
                texts = pieces.load_decoder(path).decode(np.frombuffer(data, np.int32), ends.tolist())
                values = [hashlib.sha256(t).hexdigest() for t in texts]
            given.append(pa.array(values, self.FIELDS[name][1]))
        return given


def _encode_whole(path: str, tokens: Tokens):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces.load(path)
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH):
                part = batch.slice(start, BATCH)
                found = model.encode([model.marked(t) for t in part.column("segment_text").to_pylist()])
                kept = [part.column(i) for i in range(part.num_columns - 1)]
                names = [*part.schema.names[:-1], *tokens.wanted]
                yield pa.record_batch([*kept, *tokens.columns(found, path)], names=names)
        model.forget()

    return run


def _described(path: str, tokens: Tokens):
    """Like ``_encode_whole``, from ids that are known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(batch.num_rows):
                part = batch.slice(start, 1)  # a giant document
                ids = np.asarray(part.column("segment_ids").flatten(), np.int32).tobytes()
                kept = [part.column(i) for i in range(part.num_columns - 1)]
                names = [*part.schema.names[:-1], *tokens.wanted]
                yield pa.record_batch([*kept, *tokens.columns([ids], path)], names=names)

    return run


def _cut(path: str, chunk: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = pieces.load(path)
        for frame in frames:
            for row, text in zip(frame["segment_row"], frame["segment_text"]):
                marked = model.marked(text)
                starts = range(0, len(marked), chunk)
                for part in range(0, len(starts), 64):
                    some = starts[part : part + 64]
                    yield pd.DataFrame(
                        {
                            "segment_row": row,
                            "chunk": range(part, part + len(some)),
                            "own": [min(chunk, len(marked) - s) for s in some],
                            "chunk_text": [marked[s : s + chunk + model.longest - 1] for s in some],
                        }
                    )

    return run


def _matrices(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces.load(path)
        for batch in batches:
            for start in range(0, batch.num_rows, TRACED):
                part = batch.slice(start, TRACED)
                texts, own = part.column("chunk_text").to_pylist(), part.column("own").to_pylist()
                found = [transfer(model, t, n).tobytes() for t, n in zip(texts, own)]
                at = [part.column("segment_row"), part.column("chunk")]
                yield pa.record_batch([*at, pa.array(found, pa.binary())], names=["segment_row", "chunk", "matrix"])

    return run


def _product(width: int):
    """The matrix of a block of chunks, combined in pairs of neighbours."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("chunk")
        left = [np.frombuffer(data).reshape(width, width) for data in frame["matrix"]]
        while len(left) > 1:
            pairs = [combine(a, b) for a, b in zip(left[::2], left[1::2])]
            left = pairs + left[len(pairs) * 2 :]
        return frame[["segment_row", "block"]].iloc[:1].assign(matrix=[left[0].tobytes()])

    return run


def _scan(width: int, place: str):
    """The scores that enter each of some neighbours, from those that enter the first."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(place)
        scores, entries = np.frombuffer(frame["first"].iloc[0]), []
        for data in frame["matrix"]:
            entries.append(scores.tobytes())
            scores = (scores[:, None] + np.frombuffer(data).reshape(width, width)).max(axis=0)
        return frame[["segment_row", place]].assign(entry=entries)

    return run


def entering(matrices: DataFrame, width: int, block: int = BLOCK) -> DataFrame:
    """segment_row, chunk and entry, the scores that enter each chunk, from all chunks' matrices."""
    scores = np.full(width, pieces.LOW)
    scores[0] = 0.0
    matrices = settle(matrices.withColumn("block", F.floor(F.col("chunk") / block).cast("int")), "matrices")
    blocks = matrices.groupBy("segment_row", "block").applyInPandas(
        _product(width), "segment_row long, block int, matrix binary"
    )
    first = F.lit(bytearray(scores.tobytes()))
    into = (
        blocks.withColumn("first", first)
        .groupBy("segment_row")
        .applyInPandas(_scan(width, "block"), "segment_row long, block int, entry binary")
        .withColumnRenamed("entry", "first")
    )
    return (
        matrices.join(into, ["segment_row", "block"])
        .groupBy("segment_row", "block")
        .applyInPandas(_scan(width, "chunk"), "segment_row long, chunk int, entry binary")
    )


def _traces(path: str):
    states = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces.load(path)
        for batch in batches:
            for start in range(0, batch.num_rows, TRACED):
                part = batch.slice(start, TRACED)
                texts, own, entries = (part.column(c).to_pylist() for c in ("chunk_text", "own", "entry"))
                found = trace_chunks(model, list(zip(texts, own, map(np.frombuffer, entries))))
                columns = [
                    part.column("segment_row"),
                    part.column("chunk"),
                    pa.array([f[0] for f in found], states),
                    pa.array([f[1] for f in found], states),
                    pa.array([f[2] for f in found], pa.list_(states)),
                ]
                yield pa.record_batch(columns, names=["segment_row", "chunk", "shared", "states", "ends"])
        model.forget()

    return run


def _link(frame: pd.DataFrame) -> pd.DataFrame:
    """Ids of one document: the last chunk ends in state 0, each gives the exit of the one before."""
    frame = frame.sort_values("chunk", ascending=False)
    state, parts = 0, []
    for shared, states, ends in zip(frame["shared"], frame["states"], frame["ends"]):
        parts.append(np.concatenate([shared, ends[state]]).astype(np.int32))
        state = states[state]
    return pd.DataFrame(
        {"segment_row": frame["segment_row"].iloc[:1], "segment_ids": [np.concatenate(parts[::-1])]}
    )


def encode(
    docs: DataFrame,
    keep: tuple[str, ...] = ("doc_id",),
    path: str = pieces.MODEL,
    chunk: int = CHUNK,
    give: tuple[str, ...] = ("ids",),
    block: int = BLOCK,
) -> DataFrame:
    """The columns ``keep``, and of ``Tokens`` those to ``give``; ids are the piece numbers of a text.

    What is hashed or decoded is so by the task that has the ids, which need not leave it.
    """
    ship(docs.sparkSession)
    tokens = Tokens(give)
    rows = docs.select(*keep, text_of("text").alias("segment_text"))
    schema = T.StructType([*(docs.schema[c] for c in keep), *tokens.fields])
    giant = F.length("segment_text") >= chunk
    small = rows.where(~giant).mapInArrow(_encode_whole(path, tokens), schema)

    # A row number tells giant documents apart; writing it makes it last.
    large = settle(
        rows.where(giant).withColumn("segment_row", F.monotonically_increasing_id()), "giant"
    )
    width = pieces.load(path).longest
    at = "segment_row long, chunk int"
    chunks = settle(
        large.select("segment_row", "segment_text")
        .mapInPandas(_cut(path, chunk), f"{at}, own int, chunk_text string")
        .repartition("segment_row", "chunk"),
        "chunks",
    )
    entries = entering(chunks.mapInArrow(_matrices(path), f"{at}, matrix binary"), width, block)
    linked = (
        chunks.join(entries, ["segment_row", "chunk"])
        .select("segment_row", "chunk", "own", "chunk_text", "entry")
        .mapInArrow(
            _traces(path), f"{at}, shared array<int>, states array<int>, ends array<array<int>>"
        )
        .groupBy("segment_row")
        .applyInPandas(_link, "segment_row long, segment_ids array<int>")
    )
    found = large.drop("segment_text").join(linked, "segment_row").select(*keep, "segment_ids")
    return small.unionByName(found.mapInArrow(_described(path, tokens), schema))


def decode(encoded: DataFrame, path: str = pieces.MODEL) -> DataFrame:
    """All columns with ``ids`` replaced by ``decoded``, the text of the pieces."""
    ship(encoded.sparkSession)
    fields = [f for f in encoded.schema.fields if f.name != "ids"]
    schema = T.StructType([*fields, T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = pieces.load_decoder(path)
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH):
                part = batch.slice(start, BATCH)
                lists = part.column("ids")
                ends = np.cumsum(lists.value_lengths().to_pylist(), dtype=np.int64)
                texts = decoder.decode(np.asarray(lists.flatten(), np.int32), ends.tolist())
                texts = [t.decode(errors="replace") for t in texts]
                kept = [part.column(f.name) for f in fields]
                yield pa.record_batch([*kept, pa.array(texts, pa.string())], names=schema.fieldNames())

    return encoded.select(*(f.name for f in fields), "ids").mapInArrow(run, schema)
