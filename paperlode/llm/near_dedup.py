"""Near-duplicate documents by Order MinHash.

Texts become sequences of five-word shingles (words lower-cased, punctuation left out), each
labelled with its occurrence number. For each of HASHES hash functions the two labelled shingles of
least hash are kept in the order they have in the text, so that sketches agree where texts agree in
content and order. Two sketch parts make a bucket; texts that share a bucket are candidates. A
candidate pair is a link if a banded alignment of its shingle sequences matches at least four
fifths of all distinct positions: m / (n1 + n2 - m) >= 0.8, m the aligned shingles. The band is as
wide as that similarity can need, so it loses nothing.

Results for odd input: equal texts are one class (null counts as empty); a text of one to four
words is one shingle; texts without words have copies only; class_id is the least doc_id of
the class, null if it has none; every row gets its row back.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import distilled, free_name, lean, saved, slices, table, text_key
from .components import Matcher, met_by_id, near_components
from .packed import shared_buckets
from .words import BASE, lowered_words, mix, windows

WORDS, HASHES, BANDS = 5, 40, 20
SLICE_BYTES = 1 << 20
U = np.uint64


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts, and each text's first one."""
    words, of = lowered_words(texts)
    grams, first = windows(words, of, WORDS)
    count, n = np.diff(first), np.diff(of)
    few = np.flatnonzero((n > 0) & (n < WORDS))
    if len(few):
        whole = [mix(np.array([hash(tuple(words[of[t] : of[t + 1]].tolist())) & (2**64 - 1)], np.uint64))[0] for t in few]
        grams = np.insert(grams, first[few], np.array(whole, np.uint64))
        count[few] = 1
        first = np.concatenate([[0], np.cumsum(count)])
    return grams, first


def order_minhash(grams: np.ndarray, first: np.ndarray) -> np.ndarray:
    """BANDS buckets for each text that has shingles, in the order of the texts."""
    count = np.diff(first)
    some = np.flatnonzero(count)
    starts, count = first[:-1][some], count[some]
    text = np.repeat(np.arange(len(some)), count)
    with np.errstate(over="ignore"):
        # occurrence numbers: equal shingles of one text in text order
        own = mix(grams + text.astype(np.uint64) * U(BASE))
        order = np.argsort(own, kind="stable")
        ranked = own[order]
        new = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        nth = np.empty(len(own), np.uint64)
        nth[order] = np.arange(len(own)) - np.repeat(new, np.diff(np.append(new, len(own))))
        label = mix(grams + nth * U(0xD6E8FEB86659FD93))
        out = np.empty((len(some), BANDS), np.uint64)
        top, one = U(2**64 - 1), count == 1
        for band in range(BANDS):
            bucket = np.full(len(some), band + 1, np.uint64)
            for part in range(HASHES // BANDS):
                seed = 2 * (band * (HASHES // BANDS) + part) + 1
                h = (label ^ U(seed * BASE & (2**64 - 1))) * U((seed * 0xA24BAED4963EE407 & (2**64 - 1)) | 1)
                least = np.minimum.reduceat(h, starts)
                at1 = np.flatnonzero(h == np.repeat(least, count))
                if len(at1) != len(some):  # equal hashes of different shingles: take the first
                    at1 = at1[np.unique(text[at1], return_index=True)[1]]
                h[at1] = top
                least = np.minimum.reduceat(h, starts)
                at2 = np.flatnonzero(h == np.repeat(least, count))
                if len(at2) != len(some):
                    at2 = at2[np.unique(text[at2], return_index=True)[1]]
                a, b = np.minimum(at1, at2), np.maximum(at1, at2)
                pair = np.where(one, label[at1], mix(label[a] * U(3)) + label[b])
                bucket = mix(bucket * U(BASE) + pair)
            out[:, band] = bucket
    return out


def aligned(a: list[int], b: list[int], band: int) -> int:
    """Length of the longest common subsequence with matches at most band places apart.

    Bit-parallel: bit i of v is 0 where the subsequence up to row i is one longer than up to the
    row before; v holds the rows inside the band and moves on by one row with every step.
    """
    places: dict[int, list[int]] = defaultdict(list)
    for i, x in enumerate(a):
        places[x].append(i)
    width = 2 * band + 1
    full, top = (1 << width) - 1, 1 << (width - 1)
    v, done = full, 0
    for j, x in enumerate(b):
        low = j - band
        p = places.get(x)
        if p:
            if len(p) == 1:
                mask = 1 << (p[0] - low) if low <= p[0] < low + width else 0
            else:
                inside = p[bisect_left(p, low) : bisect_left(p, low + width)]
                if len(inside) < 24:
                    mask = sum(1 << (i - low) for i in inside)
                else:
                    bits = np.zeros(width, np.uint8)
                    bits[np.array(inside) - low] = 1
                    mask = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
            if mask:
                u = v & mask
                v = ((v + u) | (v - u)) & full
        done += not v & 1
        v = v >> 1 | top
    return done + width - v.bit_count()


def codes_of(payload: bytes) -> np.ndarray:
    return np.frombuffer(payload, "<u4")


def near(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sequences of 32-bit codes are similar enough."""
    if len(a) > len(b):
        a, b = b, a
    need = -(-4 * (len(a) + len(b)) // 9)
    if need > len(a):
        return False
    same = np.flatnonzero(a != b[: len(a)])
    head = int(same[0]) if len(same) else len(a)
    if head >= need:
        return True
    same = np.flatnonzero(a[head:][::-1] != b[len(b) - len(a) + head :][::-1])
    tail = int(same[0]) if len(same) else len(a) - head
    if head + tail >= need:
        return True
    a2, b2 = a[head : len(a) - tail], b[head : len(b) - tail]
    if head + tail + np.isin(a2, b2).sum() < need:
        return False
    return head + tail + aligned(a2.tolist(), b2.tolist(), len(b) - need) >= need


def features(payload: bytes) -> np.ndarray:
    """The codes with their occurrence numbers: no two are equal, and two sequences can't have more
    aligned codes than they have of these in common."""
    codes = codes_of(payload)
    order = np.argsort(codes, kind="stable")
    ranked = codes[order]
    new = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    nth = np.empty(len(codes), np.uint64)
    nth[order] = np.arange(len(codes)) - np.repeat(new, np.diff(np.append(new, len(codes))))
    return nth << U(32) | codes.astype(np.uint64)


MATCHER = Matcher(codes_of, near, features)


def _row_key(text: Column) -> Column:
    return text_key(F.coalesce(text, F.lit("")))


def _sketch(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """ids and buckets of the texts of a batch (id, text) that have shingles."""
    start = 0
    for part in slices(batch.column(1), SLICE_BYTES):
        ids = batch.column(0).slice(start, len(part)).to_numpy()
        start += len(part)
        grams, first = shingles(part)
        if len(grams):
            yield ids[np.diff(first) > 0], order_minhash(grams, first), ids[:0]


def _codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        start = 0
        for part in slices(batch.column(2), SLICE_BYTES):
            grams, first = shingles(part)
            codes = (grams >> U(32)).astype("<u4")
            payload = pa.array([codes[a:b].tobytes() for a, b in zip(first, first[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(start, len(part)) for i in (0, 1)), payload], ["id", "node", "payload"])
            start += len(part)


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every different text of docs: node, class_id, least (its own least id), n_least (rows
    that have it) and keeper (whether it is the one text of its class that stays)."""
    return distilled(docs.sparkSession, "classes", lambda: _classes(docs, id_col, text_col))


def _classes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    texts = docs.select(docs[id_col].alias("doc"), _row_key(docs[text_col]).alias("node"), docs[text_col].alias("text"))
    ids = texts.groupBy("node", "doc").agg(F.count("*").alias("n"))
    nodes = ids.groupBy("node").agg(F.min(F.struct(F.col("doc").isNull(), "doc", "n")).alias("m"))
    nodes = saved(nodes.select("node", F.col("m.doc").alias("least"), F.col("m.n").alias("n_least")), "nodes")
    short = F.xxhash64("node").alias("id")

    def payloads(wanted: DataFrame) -> DataFrame:
        # one row of each text: that of least id, so that copies don't meet in one task
        reps = nodes.select(short, "node", "least").join(wanted, "id", "left_semi").select(F.col("node").alias("key"), "least")
        rows = texts.join(reps, (texts.node == reps.key) & texts.doc.eqNullSafe(reps.least)).select(short, "node", "text")
        return rows.mapInArrow(lean(_codes), "id long, node binary, payload binary").dropDuplicates(["node"])

    members = shared_buckets(texts.select(short, "text"), _sketch)
    roots = near_components(members, met_by_id(members), payloads, MATCHER)
    best = roots.join(nodes, "node").groupBy("root").agg(F.min(F.struct(F.col("least").isNull(), "least", "node")).alias("best"))
    linked = roots.join(best, "root").select("node", F.col("best.least").alias("linked_id"), F.col("best.node").alias("stays"))
    out = nodes.join(linked, "node", "left")
    return out.select("node", F.coalesce("linked_id", "least").alias("class_id"), "least", "n_least", F.coalesce(F.col("stays") == F.col("node"), F.lit(True)).alias("keeper"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col and class_id of every row."""
    found = classes(docs, id_col, text_col)
    keys = docs.select(docs[id_col], _row_key(docs[text_col]).alias("node"))
    return keys.join(found, "node").select(id_col, "class_id")


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of docs for each class: that of least doc_id, which may be null, and text key. Of
    repeated rows one stays; further columns, whatever their names, come along."""
    kept = classes(docs.select("doc_id", "text")).where("keeper")
    key = free_name(docs.columns, "kept_node")
    kept = kept.select(F.col("node").alias(key), "least", "n_least")
    rows = docs.withColumn(key, _row_key(docs["text"])).alias("rows")
    kept = kept.alias("kept")
    on = (F.col(f"rows.{key}") == F.col(f"kept.{key}")) & F.col("rows.doc_id").eqNullSafe(F.col("kept.least"))
    once = rows.join(kept.where("n_least = 1"), on, "left_semi")
    again = rows.join(kept.where("n_least > 1"), on, "left_semi").dropDuplicates([key])
    return once.unionByName(again).select(*docs.columns)
