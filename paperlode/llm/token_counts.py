"""Greedy word-piece token counts by a linear longest-match automaton.

The vocabulary is a trie over bytes with two roots: words start at the first, continuations of a
word at the second. Each node has a failure link to where matching goes on once the longest piece
so far is cut off, and the number of pieces that are cut off on the way. Counting a word is one
walk over its bytes; no piece is ever built. Words that a worker has met are remembered.

Results for odd input: null and empty texts have 0 tokens; a word that no sequence of pieces
covers counts as one unknown token; repeated rows, and rows without id, get a row each; other columns
don't come along; an empty table gives an empty one.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import slices, table

#: A word: letters, marks, digits and underscores, or one other character that is not white space.
WORDS = regex.compile(r"[\p{L}\p{M}\p{N}_]+|[^\s\p{L}\p{M}\p{N}_]")
REMEMBERED, SLICE_BYTES = 500_000, 4 << 20


class LongestMatch:
    """first: pieces that start a word; rest: pieces that continue one."""

    def __init__(self, first: Iterable[bytes], rest: Iterable[bytes]):
        self.child: list[dict[int, int]] = [{}, {}]
        piece = {self._add(0, p) for p in first if p} | {self._add(1, p) for p in rest if p}
        self.fail, self.pops = [-1] * len(self.child), [0] * len(self.child)
        queue = [0, 1]
        for u in queue:  # breadth first: a node's link needs those of shorter strings only
            for c, v in self.child[u].items():
                queue.append(v)
                if v in piece:
                    self.fail[v], self.pops[v] = 1, 1
                    continue
                z, n = self.fail[u], self.pops[u]
                while z >= 0 and c not in self.child[z]:
                    n += self.pops[z]
                    z = self.fail[z]
                if z >= 0:
                    self.fail[v], self.pops[v] = self.child[z][c], n
        self.known: dict[str, int] = {}

    def _add(self, at: int, piece: bytes) -> int:
        for c in piece:
            if c not in self.child[at]:
                self.child[at][c] = len(self.child)
                self.child.append({})
            at = self.child[at][c]
        return at

    def word(self, word: bytes) -> int:
        child, fail, pops = self.child, self.fail, self.pops
        u = n = 0
        for c in word:
            while (v := child[u].get(c, -1)) < 0:
                n += pops[u]
                u = fail[u]
                if u < 0:
                    return 1
            u = v
        while u != 1:
            n += pops[u]
            u = fail[u]
            if u < 0:
                return 1
        return n

    def text(self, text: str | None) -> int:
        total, known = 0, self.known
        if len(known) > REMEMBERED:
            known.clear()
        for w in WORDS.findall(text or ""):
            n = known.get(w)
            if n is None:
                n = known[w] = self.word(w.encode())
            total += n
        return total


def pieces_of_ranks(ranks_file: bytes) -> tuple[set[bytes], set[bytes]]:
    """Word-piece vocabulary from a byte-level one: tokens with a leading space start a word, the
    others continue one; every single byte may do either."""
    tokens = [base64.b64decode(a) for a, _ in map(bytes.split, ranks_file.splitlines())]
    single = {bytes([b]) for b in range(256)}
    return {t[1:] for t in tokens if t[:1] == b" " and len(t) > 1} | single, {t for t in tokens if t[:1] != b" "} | single


_counters: dict[int, LongestMatch] = {}


def counter(ranks_file: bytes) -> LongestMatch:
    key = hash(ranks_file)
    if key not in _counters:
        _counters.clear()
        _counters[key] = LongestMatch(*pieces_of_ranks(ranks_file))
    return _counters[key]


def count_tokens(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col and n_tokens of every row. The vocabulary (about 1 MB) is broadcast."""
    with open(ranks_path, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(ranks.value).text
        for batch in batches:
            n = [count(t) for part in slices(batch.column(1), SLICE_BYTES) for t in part.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], ["id", "n_tokens"])

    return docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(run, f"id {kind}, n_tokens long").withColumnRenamed("id", id_col)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
