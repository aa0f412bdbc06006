"""Token counts of a unigram model by dynamic programming over a shared trie.

Method: texts are cut into pre-tokens; the different ones are inserted, byte by byte, in a trie.
A node's forward score is the best sum of piece scores that spells its prefix, computed once for
all pre-tokens that begin with it; a pre-token's token count stands at its terminal node.

The vocabulary is a public file of ranks; piece of rank r has the integer score
-round(1024 * log2(r + 2)), so sums are exact. Among equal scores fewer pieces win.

Each Python worker has a trie of bounded size, begun anew when full; texts are read whole.

Defined results: null and empty texts have no pre-tokens and no tokens; repeated rows count each;
null doc_id is kept; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import rows_to_batch

MOST_NODES = 500_000


def piece_scores(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        ranks = (line.split() for line in f if line.strip())
        return {base64.b64decode(piece): -round(1024 * math.log2(int(rank) + 2)) for piece, rank in ranks}


class Trie:
    """Forward scores of prefixes. Nodes are numbers; 0 is the empty prefix."""

    def __init__(self, scores: dict[bytes, int]):
        self.scores = scores
        ends: dict[bytes, set[int]] = {}
        for piece in scores:
            ends.setdefault(piece[-2:], set()).add(len(piece))
        self.lengths = {end: sorted(found) for end, found in ends.items()}
        self.clear()

    def clear(self) -> None:
        self.children: dict[int, int] = {}
        self.best, self.pieces = [0], [0]

    def __len__(self) -> int:
        return len(self.best)

    def insert(self, word: bytes) -> int:
        """Number of tokens of the word."""
        node, path = 0, [0]
        children, best, pieces = self.children, self.best, self.pieces
        for end in range(1, len(word) + 1):
            edge = node << 8 | word[end - 1]
            node = children.get(edge, 0)
            if not node:
                node = children[edge] = len(best)
                score, count = self.forward(word, end, path)
                best.append(score)
                pieces.append(count)
            path.append(node)
        return pieces[node]

    def forward(self, word: bytes, end: int, path: list[int]) -> tuple[int, int]:
        tail, top, scores = word[max(0, end - 2):end], None, self.scores
        lengths = self.lengths.get(tail[-1:], ()) if len(tail) == 1 else (1, *self.lengths.get(tail, ()))
        for length in lengths:
            if length > end:
                break
            piece = scores.get(word[end - length:end])
            if piece is not None:
                start = path[end - length]
                found = (self.best[start] + piece, -self.pieces[start] - 1)
                if top is None or found > top:
                    top = found
        return top[0], -top[1]


OUT = pa.schema([("doc_id", pa.int64()), ("n_pretokens", pa.int64()), ("n_tokens", pa.int64())])


def count_tokens(docs: DataFrame, ranks: str, pattern: str, most_nodes: int = MOST_NODES) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_pretokens, n_tokens. `ranks`: path of the vocabulary file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, cut, counts = Trie(piece_scores(ranks)), regex.compile(pattern).findall, {}
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = cut(text) if text else []
                if len(trie) > most_nodes:
                    trie.clear()
                    counts.clear()
                for word in set(words).difference(counts):
                    counts[word] = trie.insert(word.encode())
                rows.append((doc_id, len(words), sum(map(counts.__getitem__, words))))
            yield rows_to_batch(rows, OUT)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long")
