"""Greedy longest-match word-piece counts by a linear automaton.

The vocabulary is a trie with two roots: pieces that begin a word and pieces
that continue one. When no longer piece fits, plain greedy matching would go
back to the end of the longest piece and read on; the automaton follows a
failure link instead, which is where reading on would lead, and adds the number
of pieces passed on the way, which is known beforehand. So each byte is read
once and only counts are kept; no piece is ever built.

Here the words are a byte-level vocabulary's: a word is the bytes between white
space, its first piece may use entries written with a leading space, later
pieces are the entries without one. A word that the vocabulary cannot spell
counts as one unknown piece.

Nulls and odd rows: null, empty and white-space texts have no words and no
tokens; a null doc_id is kept; every row is counted on its own; an empty table
gives no rows. Words of any length are read whole.
"""

from __future__ import annotations

import base64

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.base import read, ship
from ledgerloom.llm.encoding import public_path

#: Entries of a memory's young half; with the old half it holds twice as many.
REMEMBERED = 200_000


class Memory(dict):
    """A bounded memory of ``make(key)``. When the young half is full it becomes
    the old half; what is asked for again moves back, the rest is forgotten."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key):
        value = self.old.pop(key, None)
        if value is None:
            value = self.make(key)
        if len(key) < 64:
            if len(self) >= REMEMBERED:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class PieceCounter:
    """``count(word)``: how many pieces greedy longest-match-first gives.

    ``starts`` are pieces that may open a word, ``rest`` those that may follow.
    """

    def __init__(self, starts: list[bytes], rest: list[bytes]):
        # node: its edges, the piece that ends there (or none), failure link and pops
        self.next: list[dict[int, int]] = [{}, {}]
        whole = [False, False]
        for root, pieces in ((0, starts), (1, rest)):
            for p in pieces:
                at = root
                for b in p:
                    to = self.next[at].get(b)
                    if to is None:
                        to = self.next[at][b] = len(self.next)
                        self.next.append({})
                        whole.append(False)
                    at = to
                whole[at] = at > 1
        n = len(self.next)
        self.fail, self.pops = [-1] * n, [0] * n
        layer = [0, 1]
        while layer:  # breadth first: links of shorter strings are ready
            below = []
            for u in layer:
                for b, v in self.next[u].items():
                    below.append(v)
                    if whole[v]:
                        self.fail[v], self.pops[v] = 1, 1
                        continue
                    z, popped = self.fail[u], self.pops[u]
                    while z >= 0 and b not in self.next[z]:
                        popped, z = popped + self.pops[z], self.fail[z]
                    if z >= 0:
                        self.fail[v], self.pops[v] = self.next[z][b], popped
            layer = below

    def count(self, word: bytes) -> int:
        at, pieces = 0, 0
        edges, fail, pops = self.next, self.fail, self.pops
        for b in word:
            while (to := edges[at].get(b)) is None:
                pieces += pops[at]
                at = fail[at]
                if at < 0:
                    return 1  # unknown
            at = to
        while at > 1:  # the word's end: everything read must be spelt out
            pieces += pops[at]
            at = fail[at]
        return pieces if at == 1 or not word else 1


def load_counter(path: str) -> PieceCounter:
    """A counter over a vocabulary file with one base64 piece and its id a line."""
    with open(path, "rb") as f:
        pieces = [base64.b64decode(line.split()[0]) for line in f if line.strip()]
    starts = [p[1:] for p in pieces if len(p) > 1 and p[:1] == b" "]
    rest = [p for p in pieces if p[:1] != b" "]
    return PieceCounter([*starts, *(p for p in rest if len(p) == 1)], rest)


_KEPT: dict[str, Memory] = {}


def count_tokens(docs: DataFrame, vocabulary: str | None = None, *, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_bytes, n_tokens) of whole texts; no shuffle."""
    path = vocabulary or public_path("byte_bpe_50k.tiktoken")
    ship(docs.sparkSession)

    def run(batches):
        if path not in _KEPT:
            _KEPT[path] = Memory(load_counter(path).count)
        counts = _KEPT[path]
        for b in batches:
            words, size, tokens = [], [], []
            for t in b.column("t"):
                raw = (t.as_py() or "").encode()
                own = raw.split()
                words.append(len(own))
                size.append(len(raw))
                tokens.append(sum(map(counts.__getitem__, own)))
            yield pa.RecordBatch.from_arrays(
                [b.column("k"), *(pa.array(c, pa.int64()) for c in (words, size, tokens))],
                names=["doc_id", "n_words", "n_bytes", "n_tokens"])

    return docs.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t")) \
        .mapInArrow(run, "doc_id long, n_words long, n_bytes long, n_tokens long")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word-piece counts of every whole text of ``documents``."""
    return count_tokens(read(spark, sf_dir, "documents"), public_path("byte_bpe_50k.tiktoken"))
