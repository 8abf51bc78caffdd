"""Token counts of documents under the piece vocabulary, without making the tokens.

Text falls into runs that no piece leaves, so counts add up over runs. A worker inserts the
distinct runs it meets into a trie. Each node holds the best score of its path and the number of
tokens that reach it; both follow from the nodes above, so a shared prefix is scored once. The
node where a run ends holds its count. No data is shuffled.

Defined cases: a null or empty text has 0 tokens; repeated rows are counted each; a run beyond
48 characters is counted by the same recurrence without nodes that last; the trie starts again
at a bound of nodes, which changes no count; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from custvalue.llm import pieces
from custvalue.llm.common import ship, text_of

#: Nodes that a worker's trie has at most.
NODES = 600_000


class CountTrie:
    """Forward scores and token counts of all prefixes of the runs inserted so far."""

    def __init__(self, model: pieces.PieceModel, nodes: int = NODES):
        self.model = model
        self.limit = nodes
        self._clear()

    def _clear(self) -> None:
        self.child: dict[int, int] = {}  # by node and character
        self.best = [0.0]
        self.tokens = [0]
        self.terminal: dict[str, int] = {}

    def insert(self, run: str) -> int:
        """Token count of the run; stored at its node if it is not too long."""
        count = self.terminal.get(run)
        if count is not None:
            return count
        if len(run) > pieces.REMEMBERED_LENGTH:
            return len(self.model.encode_run(run))
        if max(len(self.best), len(self.terminal)) + len(run) > self.limit:
            self._clear()
        child, path = self.child, [0]
        for depth, character in enumerate(run, 1):
            key = path[-1] << 21 | ord(character)
            node = child.get(key)
            if node is None:
                node = child[key] = self._grow(run, depth, path)
            path.append(node)
        count = self.terminal[run] = self.tokens[path[-1]]
        return count

    def _grow(self, run: str, depth: int, path: list[int]) -> int:
        """A new node below ``path``, from the nodes where its last piece can start."""
        score_of, above = self.model.finals.get, depth - 1
        score, added = score_of(run[above:depth]), 1
        known = score is not None
        if not known or score == pieces.LOW:
            score, added = self.model.unknown, len(run[above].encode())
        best, tokens = self.best[path[above]] + score, self.tokens[path[above]] + added
        for start in range(depth - 2, max(-1, depth - 1 - self.model.longest), -1):
            if not known:
                break
            score = score_of(run[start:depth])
            if score is None:
                break
            score += self.best[path[start]]
            # Of equally good segmentations that with the longest last piece.
            if score >= best and score > pieces.LOW:
                best, tokens = score, self.tokens[path[start]] + 1
        self.best.append(best)
        self.tokens.append(tokens)
        return len(self.best) - 1

    def count(self, text: str) -> int:
        known, total = self.terminal, 0
        for run in self.model.split(self.model.marked(text)):
            found = known.get(run)
            if found is None:
                found = sum(map(self.insert, self.model.cut(run)))
                known = self.terminal
                if len(run) <= pieces.REMEMBERED_LENGTH:
                    known[run] = found
            total += found
        return total


def token_counts(docs: DataFrame, path: str = pieces.MODEL, nodes: int = NODES) -> DataFrame:
    """doc_id and n_tokens of every document."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = CountTrie(pieces.load(path), nodes)
        for batch in batches:
            counts = [trie.count(t) for t in batch.column(1).to_pylist()]
            yield pa.record_batch(
                [batch.column(0), pa.array(counts, pa.int64())], names=["doc_id", "n_tokens"]
            )

    return docs.select("doc_id", text_of("text").alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long"
    )
