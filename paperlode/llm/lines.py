"""Line dedup: fuzzy lines by MinHash, one line kept per component.

Lines are lower-cased with white space collapsed. The shingles of a line are its runs of SHINGLE
characters; least hashes of them under BANDS times ROWS functions make BANDS buckets. Lines that share a
bucket are compared by the exact Jaccard similarity of their shingle sets, links of JACCARD or more
are joined to components by a distributed union-find, and of each component the first line (by
doc_id, text, place) stays. Lines of less than MIN_CHARS characters, blank ones among them, carry
too little to call them copies and always stay.

Results for odd input: null texts count as empty and come back as null; rows of equal doc_id and
text count as one document and keep the same lines; rows without doc_id come last; line ends are
``\\n`` and stay as they are; a text whose lines all go becomes empty; other columns come along.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import distilled, free_name, lean, release, saved, slices, table
from .components import Matcher, met_by_id, near_components
from .packed import FILTER_BITS, id_filter, shared_buckets
from .words import BASE, mix

SHINGLE, JACCARD, MIN_CHARS = 8, 0.8, 8
#: Of pairs with a similarity of 0.8, all but 3 in 100,000 share a bucket, of 0.85 all but 4 in 10,000,000.
BANDS, ROWS = 20, 4
SLICE_BYTES = 1 << 18
#: Characters whose hashes stay in a core's cache while all functions go over them.
PIECE = 1 << 17
U, U32, BASE32 = np.uint64, np.uint32, 0x9E3779B1
FUNCTIONS = [(U32(seed * 0x9E3779B1 & 0xFFFFFFFF), U32((seed * 0x85EBCA6B & 0xFFFFFFFF) | 1)) for seed in range(1, 2 * BANDS * ROWS, 2)]


def normal(text: str) -> list[tuple[int, str]]:
    """Place and normal form of the lines that can be copies."""
    text, out = text.lower(), []
    # of all white space, only the plain space is printable
    plain = "  " not in text and text.replace("\n", "").isprintable()
    for i, line in enumerate(text.split("\n")):
        if len(line) >= MIN_CHARS and len(n := line.strip() if plain else " ".join(line.split())) >= MIN_CHARS:
            out.append((i, n))
    return out


def _mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 32-bit numbers that spreads every bit, in place."""
    t = h >> U32(16)
    for factor, shift in ((0x85EBCA6B, 13), (0xC2B2AE35, 16)):
        h ^= t
        h *= U32(factor)
        np.right_shift(h, U32(shift), out=t)
    h ^= t
    return h


def _windows(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of lines of at least SHINGLE characters, and where each line's begin."""
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.array([len(x) for x in lines])
    ends = np.cumsum(size)
    h, k, base = _mixed(codes + U32(1)), 1, BASE32
    while k < SHINGLE:  # windows of twice the length each time
        h = h[:-k] * U32(base) + h[k:]
        k, base = 2 * k, base * base & 0xFFFFFFFF
    h = _mixed(h)
    inside = np.ones(len(codes), bool)
    inside[(ends[:, None] - np.arange(1, SHINGLE)).ravel()] = False  # windows that leave their line
    return h[inside[: len(h)]], np.concatenate([[0], np.cumsum(size - SHINGLE + 1)[:-1]])


def _pieces(lines: list[str]) -> Iterator[slice]:
    """Runs of lines of at most PIECE characters (one line may have more)."""
    start = held = 0
    for i, x in enumerate(lines):
        if i > start and held + len(x) > PIECE:
            yield slice(start, i)
            start, held = i, 0
        held += len(x)
    yield slice(start, len(lines))


def signatures(lines: list[str]) -> np.ndarray:
    """BANDS buckets of each line; lines have at least SHINGLE characters."""
    least = np.empty((BANDS * ROWS, len(lines)), np.uint32)
    with np.errstate(over="ignore"):
        for piece in _pieces(lines):
            h, starts = _windows(lines[piece])
            v = np.empty_like(h)
            for (flip, factor), to in zip(FUNCTIONS, least[:, piece]):
                np.bitwise_xor(h, flip, out=v)
                np.multiply(v, factor, out=v)
                np.minimum.reduceat(v, starts, out=to)
        # two of 32 bits at a time name a bucket
        pairs = least.reshape(BANDS, ROWS // 2, 2, -1).astype(np.uint64)
        bucket = np.arange(1, BANDS + 1, dtype=np.uint64)[:, None]
        for row in range(ROWS // 2):
            bucket = mix(bucket * U(BASE) + (pairs[:, row, 0] << U(32) | pairs[:, row, 1]))
    return np.ascontiguousarray(bucket.T)


def shingle_set(payload: bytes) -> tuple[np.ndarray | None, bytes]:
    """The different shingles of a line as sorted 64-bit numbers, if its characters have a byte each,
    and the line."""
    x = _one_byte(payload)
    return None if x is None else _shingles(x), payload


def _shingles(line: bytes) -> np.ndarray:
    h = np.sort(np.ndarray((len(line) - SHINGLE + 1,), "<u8", line, 0, (1,)))
    return h[np.concatenate([[True], h[1:] != h[:-1]])]


def _one_byte(payload: bytes) -> bytes | None:
    """The line with a byte for each character, if its characters have one."""
    if payload.isascii():
        return payload
    try:
        return payload.decode("utf-8").encode("latin-1")
    except UnicodeError:
        return None


def _strings(payload: bytes) -> set[str]:
    x = payload.decode("utf-8", "surrogatepass")
    return {x[i : i + SHINGLE] for i in range(len(x) - SHINGLE + 1)}


def alike(a: tuple[np.ndarray | None, bytes], b: tuple[np.ndarray | None, bytes]) -> bool:
    """Whether two lines have a Jaccard similarity of JACCARD or more."""
    p, q = a[0], b[0]
    if p is None or q is None:
        p, q = _strings(a[1]), _strings(b[1])
    n, m = len(p), len(q)
    if min(n, m) < JACCARD * max(n, m):
        return False
    if isinstance(p, set):
        both = len(p & q)
    else:
        all_ = np.concatenate([p, q])
        all_.sort()
        both = int(np.count_nonzero(all_[1:] == all_[:-1]))
    return both >= JACCARD * (n + m - both)


def features(payload: bytes) -> np.ndarray:
    """The different shingles as 64-bit numbers, alike for lines of either kind."""
    x = _one_byte(payload)
    if x is None:
        short = {s.encode("latin-1") if max(s) < "\u0100" else hashlib.blake2b(s.encode("utf-8", "surrogatepass"), digest_size=8).digest() for s in _strings(payload)}
        return np.frombuffer(b"".join(sorted(short)), "<u8")
    return _shingles(x)


MATCHER = Matcher(shingle_set, alike, features)


def document_key(id_col: str, text_col: str) -> Column:
    """128-bit key of id and text, of two fast hashes."""
    one, two = (F.hex(F.xxhash64(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.coalesce(F.col(text_col), F.lit("")))) for seed in (3, 5))
    return F.unhex(F.concat(F.lpad(one, 16, "0"), F.lpad(two, 16, "0")))


def _ids(keys: list[bytes]) -> np.ndarray:
    """Short ids of nodes: their first eight bytes, the highest first."""
    return np.frombuffer(b"".join(k[:8] for k in keys), ">i8").astype(np.int64)


def _sketch(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """ids and buckets of the different lines of a batch of texts, and ids of those that stand there
    more than once."""
    seen: set[bytes] = set()
    for part in slices(batch.column(0), SLICE_BYTES):
        new: dict[bytes, str] = {}
        again = set()
        for _, x in (line for t in part.to_pylist() if t for line in normal(t)):
            node = node_of(x)
            if node in seen:
                again.add(node)
            else:
                seen.add(node)
                new[node] = x
        if new or again:
            yield _ids(list(new)), signatures(list(new.values())) if new else np.zeros((0, BANDS), np.uint64), _ids(list(again))


def node_of(line: str) -> bytes:
    """128-bit key of a normal form."""
    return md5(line.encode("utf-8", "surrogatepass")).digest()


def _in_order(ids: list, keys: list[bytes]) -> list[int]:
    """Rows by id and key, those without an id last."""
    some = sorted((i for i, x in enumerate(ids) if x is not None), key=lambda i: (ids[i], keys[i]))
    return some + sorted((i for i, x in enumerate(ids) if x is None), key=keys.__getitem__)


def line_places(docs: DataFrame, id_col: str, text_col: str, near: bytes, repeated: bytes) -> DataFrame:
    """id, doc, line, node, payload and later of every line whose id is in one of two filters. payload
    (the normal form) is there for ids in near. later: an equal line comes before it in the same
    batch of rows, so that it can't be the one that stays; a line that every row has is so left
    once a batch."""
    kind = docs.schema[id_col].dataType
    fields = {"doc": pa.binary(), "line": pa.int32(), "node": pa.binary(), "payload": pa.binary(), "later": pa.bool_()}
    sent = docs.sparkSession.sparkContext.broadcast((near, repeated))
    last = FILTER_BITS - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, several = sent.value
        for batch in batches:
            ids, keys, texts = batch.columns
            docs_ = keys.to_pylist()
            seen: dict[bytes, tuple[bytes, int]] = {}
            at, rows = [], []
            for i in _in_order(ids.to_pylist(), docs_):
                doc = docs_[i]
                for line, x in normal(texts[i].as_py() or ""):
                    data = x.encode("utf-8", "surrogatepass")
                    node = md5(data).digest()
                    bit = int.from_bytes(node[:8], "big") & last
                    byte, bit = bit >> 3, 1 << (bit & 7)
                    if wanted[byte] & bit or several[byte] & bit:
                        later = seen.setdefault(node, (doc, line)) != (doc, line)
                        at.append(i)
                        rows.append((doc, line, node, data if wanted[byte] & bit and not later else None, later))
            if rows:
                columns = [pa.array(x, t) for x, t in zip(zip(*rows), fields.values())]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(at, pa.int64())), *columns], ["id", *fields])

    rows = docs.select(F.col(id_col).alias("id"), document_key(id_col, text_col).alias("doc"), F.col(text_col).alias("text"))
    return rows.mapInArrow(lean(run), f"id {kind.simpleString()}, doc binary, line int, node binary, payload binary, later boolean")


#: The id of a node in Spark, as _ids gives it.
SHORT = "cast(conv(hex(substring(node, 1, 8)), 16, -10) as long)"


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc (document_key) and line (from 0) of every line that goes."""
    return distilled(docs.sparkSession, "dropped", lambda: _dropped_lines(docs, id_col, text_col))


def _dropped_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    found = shared_buckets(docs.select(text_col), _sketch, repeats=True)
    release(docs.sparkSession)
    shared = F.col("bucket").isNotNull() | F.col("other").isNotNull()
    members = found.where(shared)
    # the filters have a fixed size: where they are full, all lines pass, and joins do their work
    met = met_by_id(members)
    near, repeated = id_filter(met), id_filter(found.where(~shared))
    places = saved(line_places(docs, id_col, text_col, near, repeated), "places")
    first = places.where("not later")

    def payloads(wanted: DataFrame) -> DataFrame:
        rows = first.where("payload is not null").select(F.expr(SHORT).alias("id"), "node", "payload")
        return rows.join(wanted, "id", "left_semi").dropDuplicates(["id", "node"])

    roots = near_components(members, met, payloads, MATCHER)
    counted = first.withColumn("n", F.count("*").over(Window.partitionBy("node"))).join(roots, "node", "left").where("n > 1 or root is not null")
    place = F.struct(F.col("id").isNull(), "id", "doc", "line")
    copies = saved(counted.select("doc", "line", F.coalesce("root", "node").alias("root"), place.alias("place")), "copies")
    stays = copies.groupBy("root").agg(F.min("place").alias("stays"))
    gone = copies.join(stays, "root").where("place <> stays").select("doc", "line")
    return gone.union(places.where("later").select("doc", "line")).distinct()


def _without(texts: pd.Series, gone: pd.Series) -> pd.Series:
    def one(text: str | None, lines: np.ndarray | None) -> str | None:
        if text is None or lines is None:
            return text
        out = set(lines.tolist())
        return "\n".join(x for i, x in enumerate(text.split("\n")) if i not in out)

    return pd.Series([one(t, g) for t, g in zip(texts, gone)], dtype=object)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", column: str = "dropped") -> DataFrame:
    """docs with only the lines that stay in text_col; column (array) has the places of those that
    went, null where none did. A column of that name is replaced; all others come along."""
    docs = docs.drop(column)
    key = free_name([*docs.columns, column], "dedup_key")
    gone = dropped_lines(docs, id_col, text_col).groupBy(F.col("doc").alias(key)).agg(F.sort_array(F.collect_list("line")).alias(column))
    rows = docs.withColumn(key, document_key(id_col, text_col)).join(gone.hint("shuffle_hash"), key, "left").drop(key)
    # texts that stay whole are not sent to Python
    some = F.col(column).isNotNull()
    left = F.pandas_udf(_without, "string")(F.when(some, F.col(text_col)), column)
    return rows.withColumn(text_col, F.when(some, left).otherwise(F.col(text_col)))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_dropped, the SHA-256 of the text that stays, and the places that went."""
    lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("long")
    out = dedup(table(spark, sf_dir, "documents").select("doc_id", "text", lines.alias("n_lines")))
    return out.select(
        "doc_id", "n_lines", F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"), F.array_join("dropped", ",").alias("dropped"),
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs with the lines that stay; n_chars, where it is there, follows the text. Further columns,
    whatever their names, come along."""
    places = free_name(docs.columns, "dropped_line_places")
    out = dedup(docs, column=places)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(places).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*docs.columns)
