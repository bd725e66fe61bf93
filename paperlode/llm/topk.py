"""Exact top-k search by inner product on a bit-sliced index.

Vector components are quantised to integers. An index block holds some thousand rows as slices:
for each dimension and each binary digit one bitmap over the rows; these bitmaps are what the saved
index consists of. A query adds the slices of all dimensions, each shifted by the signed binary
digits of the query's component, with carry-save adders over whole bitmaps; a negative digit takes
the complemented slices, which shifts all scores alike. The sums come out as slices again, and the
best rows are selected from the most significant one downward. The rows left at the boundary have
equal scores, and ids decide between them.

Blocks of queries are sent to the index blocks. An index block is copied only where it gets more
than GROUP blocks of queries, or where there are fewer blocks than cores. A pair of blocks gives k
rows a query at most, so no pair of vectors is ever a row. Every row is indexed.

Results for odd input: vectors that are null or empty, or hold null or non-finite components, take
no part; a query meets rows of its own length only; components beyond 64 bits count as the
nearest 64-bit integer, and so do scores, which are ranked by their exact value; ids that are null
take no part; a row is no candidate of queries of its own id; vectors of equal id are one query, with
the best results of all of them; repeated rows are candidates each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import saved, table

K, EVERY, SCALE = 5, 50, 256
#: Rows of an index block, queries of a query block, and query blocks that a copy of an index block meets.
ROWS, QUERIES, GROUP = 32768, 256, 64
#: Scores are ranked as three parts, the lower two of this many bits.
LOW = 62
MASK = (1 << LOW) - 1


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component as double; null if any component is null or not finite."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(ok & (F.size(vector) > 0), F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


class Slices:
    """Bit slices of some rows of integers."""

    def __init__(self, rows: np.ndarray):
        n, dims = rows.shape
        low = rows.min(axis=0)
        with np.errstate(over="ignore"):
            shifted = rows.astype(np.uint64) - low.astype(np.uint64)
        digits = [int(x).bit_length() for x in shifted.max(axis=0)]
        self._set(n, low.tolist(), digits, [])
        self.ones = [[self._bitmap((shifted[:, d] >> np.uint64(i)) & np.uint64(1)) for i in range(digits[d])] for d in range(dims)]
        self.zeros = [[self.all & ~b for b in s] for s in self.ones]

    def _set(self, n: int, low: list[int], digits: list[int], ones: list) -> None:
        self.n, self.low, self.digits, self.bytes = n, low, digits, -(-n // 64) * 8
        self.all = self._bitmap(np.ones(n, bool))
        self.ones = ones
        self.zeros = [[self.all & ~b for b in s] for s in ones]

    def dump(self) -> bytes:
        """The slices as bytes, those of one dimension after the other."""
        head = np.array([self.n, len(self.low), *self.low, *self.digits], "<i8")
        return head.tobytes() + b"".join(b.tobytes() for s in self.ones for b in s)

    @classmethod
    def load(cls, data: bytes) -> Slices:
        n, dims = np.frombuffer(data, "<i8", 2).tolist()
        head = np.frombuffer(data, "<i8", 2 * dims, 16).tolist()
        maps = np.frombuffer(data, np.uint64, offset=16 + 16 * dims).reshape(-1, -(-n // 64))
        ends = np.cumsum(head[dims:]).tolist()
        out = cls.__new__(cls)
        out._set(n, head[:dims], head[dims:], [list(maps[e - d : e]) for e, d in zip(ends, head[dims:])])
        return out

    def _bitmap(self, bits: np.ndarray) -> np.ndarray:
        out = np.zeros(self.bytes, np.uint8)
        packed = np.packbits(bits.astype(bool), bitorder="little")
        out[: len(packed)] = packed
        return out.view(np.uint64)

    def sums(self, query: np.ndarray) -> tuple[list[np.ndarray | None], int]:
        """Slices of all inner products less a common base, lowest first; the base."""
        columns: list[list[np.ndarray]] = []
        base = 0
        for d, q in enumerate(query.tolist()):
            base += q * self.low[d]
            j, rest = 0, q
            while rest:
                digit = 2 - (rest & 3) if rest & 1 else 0  # signed digits: no two that follow each other are set
                if digit:
                    rest -= digit
                    if digit < 0:
                        base -= ((1 << self.digits[d]) - 1) << j
                    while len(columns) < j + self.digits[d]:
                        columns.append([])
                    for i, b in enumerate(self.ones[d] if digit > 0 else self.zeros[d]):
                        columns[i + j].append(b)
                rest >>= 1
                j += 1
        out: list[np.ndarray | None] = []
        at = 0
        while at < len(columns):
            todo = columns[at]
            up: list[np.ndarray] = []
            held = todo[0] if todo else None
            for i in range(1, len(todo) - 1, 2):  # a full adder takes three bitmaps of a digit to one, and one of the next
                b, c = todo[i], todo[i + 1]
                x = held ^ b
                up.append((held & b) | (x & c))
                x ^= c
                held = x
            if len(todo) % 2 == 0 and todo:
                up.append(held & todo[-1])
                held = held ^ todo[-1]
            out.append(held)
            if up:
                if at + 1 == len(columns):
                    columns.append([])
                columns[at + 1] += up
            at += 1
        return out, base

    def best(self, query: np.ndarray, k: int, without: np.ndarray | None = None) -> tuple[np.ndarray, list[int]]:
        """Rows of the k highest scores, of equal scores the first rows; and all their scores."""
        slices, base = self.sums(query)
        even = self.all if without is None else self.all & ~without
        sure = np.zeros_like(even)
        have = 0
        for s in reversed(slices):
            if s is None:
                continue
            high = even & s
            n = int(np.bitwise_count(high).sum())
            if have + n > k:
                even = high
            else:
                sure, have, even = sure | high, have + n, even & ~s
                if have == k:
                    break
        rows = self._rows(sure)
        if have < k:  # all rows that are left tie at the boundary
            rows = np.concatenate([rows, self._rows(even)[: k - have]])
        scores = [base + sum(int(s[r >> 6] >> np.uint64(r & 63) & np.uint64(1)) << i for i, s in enumerate(slices) if s is not None) for r in rows.tolist()]
        return rows, scores

    def _rows(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def _packed(vectors: DataFrame, size: int, sliced: bool) -> DataFrame:
    """Rows (id, vector) of each partition in blocks of one length, sorted by id: dims, ids and values
    as bytes. values are bit slices or, for queries, 64-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}  # by dimension

        def block(dims: int, least: int) -> Iterator[pa.RecordBatch]:
            ids, values = (np.concatenate(x) for x in zip(*held.pop(dims)))
            while len(ids) >= least:
                order = np.argsort(ids[:size], kind="stable")
                rows = values[:size][order]
                data = Slices(rows).dump() if sliced else rows.astype("<i8").tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([dims], pa.int32()), pa.array([ids[:size][order].astype("<i8").tobytes()], pa.binary()), pa.array([data], pa.binary())], ["dims", "ids", "values"])
                ids, values = ids[size:], values[size:]
            if len(ids):
                held[dims] = [(ids, values)]

        for batch in batches:
            ids, lists = batch.column(0).to_numpy(), batch.column(1)
            first, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            length = np.diff(first)
            for dims in np.unique(length).tolist():
                at = np.flatnonzero(length == dims)
                rows = held.setdefault(dims, [])
                rows.append((ids[at], flat[first[at][:, None] + np.arange(dims)]))
                if sum(len(i) for i, _ in rows) >= size:
                    yield from block(dims, size)
        for dims in list(held):
            yield from block(dims, 1)

    return vectors.mapInArrow(run, "dims int, ids binary, values binary")


def _dealt(rows: DataFrame, n: int) -> DataFrame:
    """rows evenly over n partitions."""
    return rows.repartitionById(n, F.pmod(F.xxhash64("id", "vector"), F.lit(n)).cast("int"))


def top_k(rows: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank (from 1), id and score of the k best rows for each query.

    Both inputs: id (long) and vector (array of longs). A query's own id is no candidate.
    """
    spark = rows.sparkSession
    ask = _packed(_dealt(queries, max(1, -(-queries.count() // QUERIES))), QUERIES, False)
    ask = saved(ask.withColumn("block", F.xxhash64("ids", "values")), "queries")
    index = _packed(_dealt(rows, max(1, -(-rows.count() // ROWS))), ROWS, True)
    index = saved(index.withColumn("block", F.xxhash64("ids", "values")), "index")
    n_ask, n_index = ask.count(), index.count()
    groups = min(max(1, n_ask), max(-(-n_ask // GROUP), -(-2 * spark.sparkContext.defaultParallelism // max(1, n_index))))
    # each index block comes first in each of its groups, and then the query blocks of that group
    copies = index.select("dims", "block", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), F.lit(False).alias("asks"), "ids", "values")
    sent = ask.select("dims", F.col("block").alias("ask"), F.pmod("block", F.lit(groups)).cast("int").alias("group"), "ids", "values")
    sent = sent.join(index.select("dims", "block"), "dims").select("dims", "block", "group", F.lit(True).alias("asks"), "ids", "values")
    parts = max(1, min(groups * max(1, n_index), 8 * spark.sparkContext.defaultParallelism))
    tasks = copies.unionByName(sent).repartition(parts, "block", "dims", "group").sortWithinPartitions("block", "dims", "group", "asks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, Slices]] = []  # should two blocks have one hash, both are searched
        at_key = None
        for batch in batches:
            out: list[tuple[int, ...]] = []
            for block, group, dims, asks, id_bytes, values in zip(*(c.to_pylist() for c in batch.columns)):
                if (block, group, dims) != at_key:
                    at_key, held = (block, group, dims), []
                ids = np.frombuffer(id_bytes, "<i8")
                if not asks:
                    held.append((ids, Slices.load(values)))
                    continue
                for q, v in zip(ids.tolist(), np.frombuffer(values, "<i8").reshape(len(ids), dims)):
                    for row_ids, slices in held:
                        lo, hi = np.searchsorted(row_ids, q, "left"), np.searchsorted(row_ids, q, "right")
                        without = None
                        if hi > lo:
                            own = np.zeros(len(row_ids), bool)
                            own[lo:hi] = True
                            without = slices._bitmap(own)
                        at, scores = slices.best(v, k, without)
                        out += [(q, i, s >> 2 * LOW, s >> LOW & MASK, s & MASK) for i, s in zip(row_ids[at].tolist(), scores)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], ["query_id", "id", "high", "mid", "low"])

    found = tasks.select("block", "group", "dims", "asks", "ids", "values").mapInArrow(run, "query_id long, id long, high long, mid long, low long")
    w = Window.partitionBy("query_id").orderBy(F.desc("high"), F.desc("mid"), F.desc("low"), "id")
    best = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    most = 2**63 - 1
    high, mid = F.col("high"), F.col("mid")
    above, below = (high > 0) | ((high == 0) & (mid > 1)), (high < -1) | ((high == -1) & (mid < MASK - 1))
    score = F.when(above, F.lit(most)).when(below, F.lit(-most - 1)).otherwise(F.shiftleft("mid", LOW).bitwiseOR(F.col("low")))
    return best.select("query_id", "rank", "id", score.alias("score"))


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("id"), quantised(F.col("embedding")).alias("vector"))
    rows = rows.where("id is not null and vector is not null")
    found = top_k(rows, rows.where(F.col("id") % EVERY == 0))
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


SQL = """
WITH v AS (
  SELECT vec_id::BIGINT AS vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""
