"""A vocabulary of scored pieces, read from a SentencePiece model file, as a unigram model.

A segmentation's score is the sum of its pieces' scores and the best one is wanted; of equally
good ones that whose last piece, then the one before it, is longest. A character that no piece
covers costs the lowest score less ten and is written as its UTF-8 bytes. The file's scores are
taken as they are: a file made for pair merging has ranks, whose sums prefer few, early pieces.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np

#: The vocabulary file; any SentencePiece file with byte pieces and identity normalization.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
UNKNOWN_PENALTY = 10.0
NORMAL, BYTE = 1, 6  # piece types of the file format
#: Longer runs are segmented each time anew and not remembered.
REMEMBERED_LENGTH = 48
#: Characters of the runs that a worker remembers before it starts again.
REMEMBERED = 1 << 20
#: Runs that are segmented in one sweep.
SWEEP = 16_384

LOW = float("-inf")


def _fields(data: bytes) -> Iterator[tuple[int, bytes | int]]:
    """Number and value of the protocol-buffer fields of a message."""

    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        tag, at = number(at)
        kind = tag & 7
        if kind == 0:
            value, at = number(at)
        elif kind == 2:
            size, at = number(at)
            value, at = data[at : at + size], at + size
        else:
            size = 4 if kind == 5 else 8
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


def _tree(scores: dict[str, float]) -> dict:
    """By character: what follows, and the score if a piece ends there."""
    root: dict = {}
    for piece in sorted(scores):
        kids = root
        for character in piece[:-1]:
            node = kids.get(character)
            if node is None:
                node = kids[character] = ({}, None)
            kids = node[0]
        known = kids.get(piece[-1])
        kids[piece[-1]] = (known[0] if known else {}, scores[piece])
    return root


class PieceTrie:
    """The pieces as a trie in arrays: what follows a node by a character is found for many at once.

    Edges lie in a hash table with open addressing, by node and character.
    """

    def __init__(self, scores: dict[str, float], ids: dict[str, int]):
        edges: dict[int, int] = {}
        score, piece_id = [LOW], [-1]
        for piece in sorted(scores):
            node = 0
            for character in piece:
                key = node << 21 | ord(character)
                node = edges.get(key, 0)
                if not node:
                    node = edges[key] = len(score)
                    score.append(LOW)
                    piece_id.append(-1)
            score[node], piece_id[node] = scores[piece], ids[piece]
        self.score, self.piece_id = np.array(score), np.array(piece_id, np.int32)
        self.shift = np.uint64(64 - (2 * len(edges)).bit_length() - 1)
        self.mask = (1 << (64 - int(self.shift))) - 1
        self.keys = np.full(self.mask + 1, -1, np.int64)
        self.nodes = np.full(self.mask + 1, -1, np.int32)
        left, nodes = np.array(list(edges), np.int64), np.array(list(edges.values()), np.int32)
        at = self._slot(left)
        while len(left):
            free = self.keys[at] < 0
            # Of edges that want the same slot the last one has it.
            self.keys[at[free]], self.nodes[at[free]] = left[free], nodes[free]
            out = self.keys[at] != left
            left, nodes, at = left[out], nodes[out], (at[out] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def step(self, nodes: np.ndarray, characters: np.ndarray) -> np.ndarray:
        """The nodes that follow; -1 where no piece goes on."""
        keys = nodes.astype(np.int64) << 21 | characters
        at = self._slot(keys)
        there = self.keys[at]
        found = np.where(there == keys, self.nodes[at], -1)
        open_ = np.flatnonzero((there != keys) & (there >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & self.mask
            there = self.keys[at[open_]]
            hit = there == keys[open_]
            found[open_[hit]] = self.nodes[at[open_[hit]]]
            open_ = open_[~hit & (there >= 0)]
        return found


class PieceModel:
    """Pieces with ids and scores, and what follows from them for segmenting text."""

    def __init__(self, pieces: list[tuple[str, float, int]]):
        self.pieces = pieces
        self.ids = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == NORMAL}
        self.scores = {p: s for p, s, kind in pieces if kind == NORMAL}
        self.byte_ids = [-1] * 256
        for i, (piece, _, kind) in enumerate(pieces):
            if kind == BYTE:
                self.byte_ids[int(piece[1:-1], 16)] = i
        if -1 in self.byte_ids:
            raise ValueError("the vocabulary has no piece for some byte")
        self.unknown = min(self.scores.values()) - UNKNOWN_PENALTY
        self.longest = max(map(len, self.ids))
        # Pieces meet at every place that no piece spans: between characters that are
        # neighbours in no piece. Whole texts are split at those that a pattern can name, before
        # space marks and around punctuation that is only joined to its own kind; the runs are
        # cut at the others.
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids):
            raise ValueError("a piece has a space mark after another character")
        self.joined = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        apart = {chr(c) for c in range(128) if not chr(c).isalnum() and chr(c) != " "}
        while mixed := {c for pair in self.joined if len(apart & set(pair)) == 1 for c in pair} & apart:
            apart -= mixed
        kind = "".join(map(re.escape, sorted(apart)))
        self.runs = re.compile(f"{SPACE}+[^{SPACE}{kind}]*|[^{SPACE}{kind}]+|[{kind}]+")
        self._known: dict[str, bytes] = {}
        self._known_size = 0

    @cached_property
    def tree(self) -> dict:
        """Pieces by character; a search forward stops where no piece goes on."""
        return _tree(self.scores)

    @cached_property
    def trie(self) -> PieceTrie:
        return PieceTrie(self.scores, self.ids)

    @cached_property
    def finals(self) -> dict[str, float]:
        """Ends of pieces with their scores; a search backward stops where no piece goes on."""
        return {p[n:]: LOW for p in self.ids for n in range(1, len(p))} | self.scores

    def forget(self) -> None:
        """Drop what was remembered of runs, so that an idle worker holds no memory for them."""
        self._known, self._known_size = {}, 0

    @staticmethod
    def marked(text: str) -> str:
        """The text as pieces see it: a space mark in front and for every space."""
        return SPACE + text.replace(" ", SPACE) if text else ""

    def split(self, marked: str) -> list[str]:
        """Runs that no piece leaves."""
        return self.runs.findall(marked)

    def forward(self, text: str, own: int, entry: list[float]) -> tuple[list[float], list[int]]:
        """Best scores at every position of pieces that start before ``own``, and their starts.

        ``entry`` are the scores of the first positions; a start of -1 marks what came from it.
        """
        tree, unknown = self.tree, self.unknown
        size = len(text)
        best, back = [LOW] * (size + 1), [-1] * (size + 1)
        best[: len(entry)] = entry[: size + 1]
        for start in range(min(own, size)):
            base = best[start]
            if base == LOW:
                continue
            node = tree.get(text[start])
            end = start + 1
            if node is None or node[1] is None:
                if base + unknown > best[end]:
                    best[end], back[end] = base + unknown, start
                if node is None:
                    continue
                end += 1
                node = node[0].get(text[start + 1]) if end <= size else None
            while node is not None:
                further, score = node
                if score is not None:
                    score += base
                    if score > best[end]:
                        best[end] = score
                        back[end] = start
                if end == size:
                    break
                node = further.get(text[end])
                end += 1
        return best, back

    def ids_of(self, piece: str) -> list[int]:
        known = self.ids.get(piece)
        return [known] if known is not None else [self.byte_ids[b] for b in piece.encode()]

    def trace(self, text: str, back: list[int], end: int) -> tuple[int, list[int]]:
        """Position where the path to ``end`` enters, and its ids."""
        cuts = [end]
        while back[cuts[-1]] >= 0:
            cuts.append(back[cuts[-1]])
        cuts.reverse()
        return cuts[0], [i for a, b in zip(cuts, cuts[1:]) for i in self.ids_of(text[a:b])]

    def cut(self, run: str) -> list[str]:
        """Parts of a run that no piece leaves."""
        joined, parts, start = self.joined, [], 0
        for i in range(1, len(run)):
            if run[i - 1 : i + 1] not in joined:
                parts.append(run[start:i])
                start = i
        return [*parts, run[start:]]

    def encode_run(self, run: str) -> list[int]:
        """Ids of a run of any length, a part after the other."""
        found = []
        for part in self.cut(run):
            _, back = self.forward(part, len(part), [0.0])
            found += self.trace(part, back, len(part))[1]
        return found

    def _sweep(self, runs: list[str]) -> list[bytes]:
        """Ids of short runs, the longest first, all of them a character at a time."""
        trie = self.trie
        size = np.array([len(r) for r in runs], np.int64)
        text = np.frombuffer("".join(runs).encode("utf-32-le"), np.uint32).astype(np.int64)
        start = np.cumsum(size) - size
        count, longest = len(runs), int(size[0])
        best = np.full((count, longest + 1), LOW)
        best[:, 0] = 0.0
        back, last = np.zeros((count, longest + 1), np.int8), np.zeros((count, longest + 1), np.int32)
        for place in range(longest):
            rows = np.arange(np.searchsorted(-size, -place, side="left"))
            base, character = best[rows, place], text[start[rows] + place]
            node = trie.step(np.zeros(len(rows), np.int64), character)
            # A character that is no piece is named by a negative number.
            alone = (node < 0) | (trie.score[node] == LOW)
            score = base + self.unknown
            alone &= score > best[rows, place + 1]
            best[rows[alone], place + 1], back[rows[alone], place + 1] = score[alone], place
            last[rows[alone], place + 1] = -1 - character[alone]
            end = place + 1
            while True:
                on = node >= 0
                rows, node, base = rows[on], node[on], base[on]
                if not len(rows):
                    break
                score = base + trie.score[node]
                better = score > best[rows, end]
                at = rows[better]
                best[at, end], back[at, end], last[at, end] = score[better], place, trie.piece_id[node[better]]
                further = size[rows] > end
                rows, node, base = rows[further], node[further], base[further]
                node = trie.step(node, text[start[rows] + end])
                end += 1
        path, steps, at = np.zeros((count, longest), np.int32), np.zeros(count, np.int64), size.copy()
        rows = np.arange(count)
        while len(rows):
            path[rows, steps[rows]] = last[rows, at[rows]]
            at[rows] = back[rows, at[rows]]
            steps[rows] += 1
            rows = rows[at[rows] > 0]
        ends = np.cumsum(steps)
        row = np.repeat(np.arange(count), steps)
        within = np.arange(len(row)) - np.repeat(ends - steps, steps)
        ids = path[row, steps[row] - 1 - within]
        data, found = ids.astype("<i4").tobytes(), []
        for e, n in zip(ends.tolist(), steps.tolist()):
            found.append(data[4 * (e - n) : 4 * e])
        for r in np.unique(row[ids < 0]).tolist():
            whole = [b for i in np.frombuffer(found[r], "<i4").tolist() for b in self._named(i)]
            found[r] = struct.pack(f"<{len(whole)}i", *whole)
        return found

    def _named(self, number: int) -> list[int]:
        return [number] if number >= 0 else [self.byte_ids[b] for b in chr(-1 - number).encode()]

    def _learn(self, runs: set[str]) -> None:
        """Segment short runs and remember them."""
        short = sorted((r for r in runs if len(r) <= REMEMBERED_LENGTH), key=len, reverse=True)
        for first in range(0, len(short), SWEEP):
            some = short[first : first + SWEEP]
            self._known.update(zip(some, self._sweep(some)))
        self._known_size += sum(map(len, short))

    def encode(self, marked: list[str]) -> list[bytes]:
        """Ids of marked texts, or of parts that no piece leaves, as 32-bit numbers."""
        split = list(map(self.split, marked))
        needed = set().union(*split)
        if self._known_size > REMEMBERED:
            self.forget()
        self._learn(needed - self._known.keys())
        known = self._known
        long = needed - known.keys()
        for run in long:
            known[run] = struct.pack(f"<{len(ids := self.encode_run(run))}i", *ids)
        found = [b"".join(map(known.__getitem__, runs)) for runs in split]
        for run in long:
            del known[run]
        return found


class Decoder:
    """Bytes of all pieces in one table, by their ids."""

    def __init__(self, pieces: list[tuple[str, float, int]]):
        output = [
            bytes([int(p[1:-1], 16)]) if kind == BYTE else p.replace(SPACE, " ").encode() if kind == NORMAL else b""
            for p, _, kind in pieces
        ]
        self.sizes = np.array([len(o) for o in output], np.int32)
        self.starts = np.cumsum(self.sizes, dtype=np.int32) - self.sizes
        self.table = np.frombuffer(b"".join(output), np.uint8)

    def decode(self, ids: np.ndarray, ends: list[int]) -> list[bytes]:
        """UTF-8 of consecutive texts, whose ids end at ``ends``; without the space in front."""
        sizes = self.sizes[ids]
        upto = np.cumsum(sizes, dtype=np.int64)
        total = int(upto[-1]) if len(upto) else 0
        at = np.arange(total) + np.repeat(self.starts[ids] - (upto - sizes), sizes)
        data, found, start = self.table[at].tobytes(), [], 0
        for end in ends:
            stop = int(upto[end - 1]) if end else 0
            found.append(data[start + data.startswith(b" ", start, stop) : stop])
            start = stop
        return found


def _read(path: str) -> list[tuple[str, float, int]]:
    pieces = []
    with open(path, "rb") as file:
        for number, value in _fields(file.read()):
            if number == 1:
                piece = dict(_fields(value))
                score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
                pieces.append((piece[1].decode(), score, piece.get(3, NORMAL)))
    return pieces


@lru_cache(maxsize=2)
def load(path: str = MODEL) -> PieceModel:
    """The model of a file; a worker reads it once."""
    return PieceModel(_read(path))


@lru_cache(maxsize=2)
def load_decoder(path: str = MODEL) -> Decoder:
    """What decoding needs of a file, which is far less than the model."""
    return Decoder(_read(path))
