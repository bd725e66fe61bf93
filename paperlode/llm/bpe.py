"""Byte-level BPE encoding and decoding with padded numpy matrices.

Texts are cut into pieces by the vocabulary's pattern. Pieces that a worker has not met yet are
put into matrices by length, padded to a common width; in each round every row merges its leftmost
pair of minimum rank, pairs are looked up in an open-addressing hash table, and finished rows leave
the matrix. Pieces longer than LONG bytes are merged with a heap, in n log n steps, to the same ids:
a row of a matrix takes as many rounds as it has merges, each as long as the row, which grows with
the square of a piece's length.

Results for odd input: a null text is an empty one, with no ids; ids of a text do not depend on
the other rows of its batch; repeated rows, and rows without id, get a row each; other columns of the
input don't come along, whatever their names; an empty table gives an empty one.
"""

from __future__ import annotations

import base64
import heapq
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import kept, lean, slices, table

NONE = np.iinfo(np.int32).max
#: Bytes from which a piece is merged with a heap, pieces that a worker remembers, bytes of texts
#: and cells of a matrix that are worked on at once.
LONG, REMEMBERED, SLICE_BYTES, CELLS = 128, 300_000, 4 << 20, 1 << 20


def exact_pattern(pattern: str) -> str:
    r"""The pattern with \s as Unicode's White_Space, as the tokenizer's own regex engine has it."""
    return pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")


def narrow_pattern(pattern: str) -> str:
    """The same pattern for the characters before U+0250, with classes spelled out; a faster
    engine can run it on texts that have no others."""
    chars = [chr(i) for i in range(0x250)]
    letters, numbers = ("".join(re.escape(c) for c in chars if unicodedata.category(c)[0] == kind) for kind in "LN")
    space = "\t\n\x0b\x0c\r \x85\xa0"
    out = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{space}{letters}{numbers}]")
    return out.replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{numbers}]").replace(r"\s", f"[{space}]").replace(r"\S", f"[^{space}]")


class PairTable:
    """(left id, right id) -> merged id, by multiplicative hashing and linear probing."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(left)) * 4))))
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.vals = np.full(1 << self.bits, NONE, np.int32)
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        slot, todo = self._slot(key), np.arange(len(key))
        while len(todo):
            free = todo[self.keys[slot[todo]] < 0]
            self.keys[slot[free]] = key[free]  # of several in one slot the last one stays
            self.vals[slot[free]] = merged[free]
            todo = todo[self.keys[slot[todo]] != key[todo]]
            slot[todo] = (slot[todo] + 1) & (len(self.keys) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged ids, NONE where the pair has none; ids below 0 are padding."""
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        slot = self._slot(key)
        held = self.keys[slot]
        out = np.where(held == key, self.vals[slot], NONE).astype(np.int32)
        out[(left < 0) | (right < 0)] = NONE
        todo = np.flatnonzero((held != key) & (held >= 0) & (left >= 0) & (right >= 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & (len(self.keys) - 1)
            held = self.keys[slot[todo]]
            hit = held == key[todo]
            out[todo[hit]] = self.vals[slot[todo[hit]]]
            todo = todo[~hit & (held >= 0)]
        return out


class BytePairCoder:
    def __init__(self, ranks_file: bytes, pattern: str):
        self.any_pieces, self.narrow_pieces = regex.compile(exact_pattern(pattern)).findall, re.compile(narrow_pattern(pattern)).findall
        self.is_narrow = re.compile("[\\0-\\u024f]*").fullmatch
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_file.splitlines()) if a}
        self.token = {b: a for a, b in ranks.items()}
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        self.pairs = PairTable(*np.array(pairs, np.int64).reshape(-1, 3).T)
        self.pair_of = {(a, b): c for a, b, c in pairs}
        self.whole = {t: np.array([r], "<u4").tobytes() for t, r in ranks.items()}
        self.known: dict[str, bytes] = {}

    def pieces(self, text: str) -> list[str]:
        return self.narrow_pieces(text) if self.is_narrow(text) else self.any_pieces(text)

    def merge_matrix(self, rows: list[bytes]) -> list[bytes]:
        """Ids, as little-endian 32-bit integers, of pieces of similar length."""
        size = np.array([len(r) for r in rows])
        width = int(size.max())
        flat = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in rows), np.uint8).reshape(len(rows), width)
        ids = self.byte_id[flat]
        ids[np.arange(width) >= size[:, None]] = -1
        out: list[bytes] = [b""] * len(rows)
        at = np.arange(len(rows))
        rank = np.full(ids.shape, NONE, np.int32)
        rank[:, :-1] = self.pairs.get(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(rows), width - 1)
        while len(at):
            j = rank.argmin(axis=1)
            r = np.arange(len(at))
            best = rank[r, j]
            over = best == NONE
            if over.any():
                for i in np.flatnonzero(over):
                    out[at[i]] = ids[i, ids[i] >= 0].astype("<u4").tobytes()
                stay = ~over
                at, ids, rank, j, best = at[stay], ids[stay], rank[stay], j[stay], best[stay]
                r = np.arange(len(at))
                if not len(at):
                    break
            ids[r, j] = best
            cols = np.arange(ids.shape[1] - 1)
            source = cols + (cols > j[:, None])
            ids, rank = np.take_along_axis(ids, source, 1), np.take_along_axis(rank, source, 1)
            ids = np.pad(ids, ((0, 0), (0, 1)), constant_values=-1)[:, : max(2, ids.shape[1])]
            rank = np.pad(rank, ((0, 0), (0, 1)), constant_values=NONE)[:, : max(2, rank.shape[1])]
            right = np.where(j + 1 < ids.shape[1], ids[r, np.minimum(j + 1, ids.shape[1] - 1)], -1)
            rank[r, j] = self.pairs.get(ids[r, j], right)
            has = j > 0
            rank[r[has], j[has] - 1] = self.pairs.get(ids[r[has], j[has] - 1], ids[r[has], j[has]])
        return out

    def merge_long(self, piece: bytes) -> bytes:
        """The same merges for one long piece: a heap of pairs over a linked list."""
        ids = self.byte_id[np.frombuffer(piece, np.uint8)].tolist()
        n, pair_of = len(ids), self.pair_of
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m, i, ids[i], ids[i + 1]) for i in range(n - 1) if (m := pair_of.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            m, i, a, b = heapq.heappop(heap)
            k = after[i]
            if ids[i] != a or k >= n or ids[k] != b:
                continue
            ids[i], ids[k], after[i] = m, -1, after[k]
            if after[k] < n:
                before[after[k]] = i
                if (x := pair_of.get((m, ids[after[k]]))) is not None:
                    heapq.heappush(heap, (x, i, m, ids[after[k]]))
            if (p := before[i]) >= 0 and (x := pair_of.get((ids[p], m))) is not None:
                heapq.heappush(heap, (x, p, ids[p], m))
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    def learn(self, pieces: set[str]) -> None:
        """Puts the ids of pieces into known."""
        buckets: dict[int, list[tuple[str, bytes]]] = {}
        for p in pieces:
            b = p.encode()
            if b in self.whole:
                self.known[p] = self.whole[b]
            elif len(b) > LONG:
                self.known[p] = self.merge_long(b)
            else:
                buckets.setdefault(-(-len(b) // 4) * 4 if len(b) > 12 else len(b), []).append((p, b))
        for width, bucket in buckets.items():
            step = max(1, CELLS // width)
            for k in range(0, len(bucket), step):
                part = bucket[k : k + step]
                self.known.update(zip((p for p, _ in part), self.merge_matrix([b for _, b in part])))

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        cut = [self.pieces(t) if t else [] for t in texts]
        wanted = set().union(*cut)
        new = wanted - self.known.keys()
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()  # then all pieces of the batch are learned again
            new = wanted
        self.learn(new)
        get = self.known.__getitem__
        return [b"".join(map(get, p)) for p in cut]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def coder(ranks_file: bytes, pattern: str) -> BytePairCoder:
    """One coder for each vocabulary and Python worker, until that works for other operators."""
    return kept((hash(ranks_file), pattern), lambda: BytePairCoder(ranks_file, pattern))


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, ids (binary: little-endian unsigned 32-bit integers) and decoded (binary), row by row.

    The vocabulary (a file of ranks, about 1 MB) is read by the driver and broadcast.
    """
    with open(ranks_path, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(ranks.value, pattern)
        for batch in batches:
            start = 0
            for part in slices(batch.column(1), SLICE_BYTES):
                ids = c.encode_batch(part.to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(part)), pa.array(ids, pa.binary()), pa.array([c.decode(x) for x in ids], pa.binary())], ["id", "ids", "decoded"]
                )
                start += len(part)

    out = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(lean(run, keeps=True), f"id {kind}, ids binary, decoded binary")
    return out.withColumnRenamed("id", id_col)


def digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of ids and decoded bytes of every row."""
    return encode(docs, ranks_path, pattern).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """digests of docs with the public byte-level vocabulary: one row for each row, whatever its text."""
    import public_tokenizers

    return digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(spark, table(spark, sf_dir, "documents"), sf_dir)
