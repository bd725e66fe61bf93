"""Shared sketch buckets, found with a shuffle of packed arrays.

A corpus has some twenty buckets a text or line, and almost all of them hold one member only. As
rows these would cost far more than the work on them. So each task packs the (bucket, id) entries
of many texts into one binary row for every range of buckets, and the task that gets a range sorts
its entries and gives back the members of buckets that hold several, as plain rows; of buckets that
hold two or three in all, the pairs.

Hot buckets: entries of equal texts are collapsed before the shuffle. A bucket that already has two
members within a packed run is known to be shared; its members there go to tasks at random, and
only a mark goes to the bucket's own range. What meets in one task is so bounded by the number of
runs, however many members a bucket has.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, saved, shuffle_partitions

#: Entries of a packed run (13 bytes each), and members of a row that goes to a task at random.
RUN, CHUNK = 1 << 20, 1 << 16
#: Bits of a bucket within its range; with the range's number they name it. Two buckets of one name
#: only make further candidates.
BITS = 40
SINGLE, MARK, MEMBERS, PLACES = 0, 1, 2, 3
FIELDS = {"part": pa.int32(), "kind": pa.int32(), "low": pa.binary(), "high": pa.binary(), "ids": pa.binary()}
SCHEMA = "part int, kind int, low binary, high binary, ids binary"
MEMBER = ["bucket", "id", "met", "other"]

#: Bits of a filter (8 MB).
FILTER_BITS = 1 << 26

Sketch = Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray]]]


def _runs(sorted_names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of runs of equal values."""
    new = np.flatnonzero(np.concatenate([[True], sorted_names[1:] != sorted_names[:-1]])) if len(sorted_names) else np.zeros(0, np.int64)
    return new, np.diff(np.append(new, len(sorted_names)))


def names_of(buckets: np.ndarray, parts: int) -> np.ndarray:
    """Range (the high part) and low bits of 64-bit buckets."""
    high, low = buckets >> np.uint64(32), buckets & np.uint64((1 << BITS) - 1)
    return (high * np.uint64(parts) >> np.uint64(32)) << np.uint64(BITS) | low


def packed_run(ids: np.ndarray, bands: np.ndarray, again: np.ndarray | None, parts: int) -> pa.RecordBatch:
    """Rows of SCHEMA for the ids (int64) and bands (uint64, a row an id) of a run; again: ids that it
    has once more, or None where no one asks for repeated ids."""
    ids, first, n = np.unique(ids, return_index=True, return_counts=True)
    names, owner = names_of(bands[first].ravel(), parts), np.repeat(ids, bands.shape[1])
    order = np.argsort(names)
    names, owner = names[order], owner[order]
    same = np.zeros(len(names) + 1, bool)  # as the one before
    np.equal(names[1:], names[:-1], out=same[1:-1])
    alone = ~(same[1:] | same[:-1])
    rows: list[tuple] = []

    def ranges(kind: int, names: np.ndarray, owner: np.ndarray | None) -> None:
        part = names >> np.uint64(BITS)
        low, high = names.astype("<u4"), (names >> np.uint64(32)).astype(np.uint8)
        for s, n in zip(*_runs(part)):
            rows.append((int(part[s]), kind, low[s : s + n].tobytes(), high[s : s + n].tobytes(), None if owner is None else owner[s : s + n].tobytes()))

    ranges(SINGLE, names[alone], owner[alone])
    ranges(MARK, names[same[1:] & ~same[:-1]], None)
    names, owner = names[~alone].astype("<u8"), owner[~alone]
    for s in range(0, len(names), CHUNK):
        to = int(owner[s].astype(np.uint64) % np.uint64(parts))
        rows.append((to, MEMBERS, names[s : s + CHUNK].tobytes(), None, owner[s : s + CHUNK].tobytes()))
    if again is not None:
        more = np.unique(np.concatenate([again, ids[n > 1]]))
        ids = np.sort(np.concatenate([ids, more]).view(np.uint64))
        part = (ids >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
        rows += [(int(part[s]), PLACES, None, None, ids[s : s + n].tobytes()) for s, n in zip(*_runs(part))]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(FIELDS.values())], list(FIELDS))


def shared_members(parts_of: list[tuple[int, int, bytes, bytes, bytes]]) -> Iterator[tuple[np.ndarray | None, np.ndarray, tuple[np.ndarray, np.ndarray]]]:
    """bucket, id and (met, whole) of the members of shared buckets, of the rows of one range or more;
    ids that come more than once without a bucket. met: how many members the bucket has, as far as
    seen; whole: these are all that it has, one after the other by id."""
    placed = [np.frombuffer(ids, "<i8") for _, kind, _, _, ids in parts_of if kind == PLACES]
    if placed:
        ids, n = np.unique(np.concatenate(placed), return_counts=True)
        yield None, ids[n > 1], (n[n > 1], np.zeros(np.count_nonzero(n > 1), bool))
    names, owner, marks = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for part, kind, low, high, ids in parts_of:
        if kind == PLACES:
            continue
        if kind == MEMBERS:
            names_ = np.frombuffer(low, "<i8")
            _, size = _runs(names_)
            yield names_, np.frombuffer(ids, "<i8"), (np.repeat(size, size), np.zeros(len(names_), bool))
            continue
        name = np.uint64(part << BITS) | np.frombuffer(high, np.uint8).astype(np.uint64) << np.uint64(32) | np.frombuffer(low, "<u4").astype(np.uint64)
        if kind == MARK:
            marks.append(name)
        else:
            names.append(name)
            owner.append(np.frombuffer(ids, "<i8"))
    name, ids = np.concatenate(names), np.concatenate(owner)
    order = np.argsort(name)
    name, again = name[order], np.zeros(len(name) + 1, bool)
    np.equal(name[1:], name[:-1], out=again[1:-1])
    at = np.unique(np.concatenate(marks))
    step = np.zeros(len(name) + 1, np.int8)
    first, end = np.searchsorted(name, at), np.searchsorted(name, at, side="right")
    step[first[first < end]] += 1
    step[end[first < end]] -= 1
    marked = np.cumsum(step[:-1], dtype=np.int8) > 0
    keep = np.flatnonzero(again[1:] | again[:-1] | marked)  # the others are alone
    if len(keep):
        name, ids, marked = name[keep], ids[order[keep]], marked[keep]
        start, size = _runs(name)
        shared = (np.minimum.reduceat(ids, start) != np.maximum.reduceat(ids, start)) | marked[start]
        keep = np.repeat(shared, size)
        name, ids, whole = name[keep], ids[keep], ~marked[keep]
        order = np.lexsort([ids, name])  # an id of several runs counts once
        name, ids = name[order], ids[order]
        new = np.ones(len(name), bool)
        new[1:] = (name[1:] != name[:-1]) | (ids[1:] != ids[:-1])
        name, ids, whole = name[new], ids[new], whole[new]
        _, size = _runs(name)
        yield name.view(np.int64), ids, (np.repeat(size, size), whole)


def whole_pairs(ids: np.ndarray, met: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The lower and the higher id of all pairs in whole buckets of two and three, and which rows are
    of other buckets."""
    two, three = ids[whole & (met == 2)].reshape(-1, 2), ids[whole & (met == 3)].reshape(-1, 3)
    ends = [np.concatenate([two[:, i], *(three[:, x[i]] for x in ((0, 1), (0, 2), (1, 2)))]) for i in (0, 1)]
    return *ends, ~(whole & (met <= 3))


def shared_buckets(rows: DataFrame, sketch: Sketch, repeats: bool = False) -> DataFrame:
    """bucket and id (long) of all members of buckets that several ids share; a member that stands in
    several runs may come more than once. Where a bucket has two or three in all, its pairs come
    instead, as id and other (a higher id) with a null bucket. With repeats, also every id that sketch
    gives more than once, with neither. met is about the number of a bucket's members.

    sketch gives, for a batch of rows, ids (int64), their buckets (uint64, as many for each id)
    and ids that it gives once more, without buckets; equal ids have equal buckets. A task holds
    the entries of its range, so there are as many ranges as shuffle partitions.
    """
    parts = shuffle_partitions(rows.sparkSession)

    def run(held: list[tuple]) -> pa.RecordBatch:
        ids, bands, again = (np.concatenate(x) for x in zip(*held))
        return packed_run(ids, bands, again if repeats else None, parts)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for got in sketch(batch):
                held.append(got)
                n += got[1].size
                if n >= RUN:
                    yield run(held)
                    held, n = [], 0
        if n:
            yield run(held)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns))]
        for buckets, ids, (met, whole) in shared_members(got):
            none = functools.partial(pa.nulls, type=pa.int64())
            if buckets is None:
                yield pa.RecordBatch.from_arrays([none(len(ids)), pa.array(ids), pa.array(met), none(len(ids))], MEMBER)
                continue
            low, high, rest = whole_pairs(ids, met, whole)
            if len(low):
                yield pa.RecordBatch.from_arrays([none(len(low)), pa.array(low), pa.array(np.full(len(low), 2)), pa.array(high)], MEMBER)
            if rest.any():
                yield pa.RecordBatch.from_arrays([*(pa.array(x[rest]) for x in (buckets, ids, met)), none(np.count_nonzero(rest))], MEMBER)

    packed = rows.mapInArrow(lean(spread), SCHEMA).repartitionById(parts, F.col("part"))
    return saved(packed.mapInArrow(lean(gather), "bucket long, id long, met long, other long"), "members")


def id_filter(ids: DataFrame) -> bytes:
    """A bitmap of FILTER_BITS with the bit of every id of ids set, whatever their number; the bits of
    others may be set as well."""
    at = F.pmod("id", F.lit(FILTER_BITS))
    maps = ids.groupBy(F.shiftright(at, 15).cast("int").alias("page")).agg(F.bitmap_construct_agg(at.bitwiseAND(F.lit(32767))).alias("bits"))
    out = np.zeros((FILTER_BITS >> 15, 4096), np.uint8)
    for row in maps.collect():  # at most FILTER_BITS / 8 bytes
        out[row.page] = np.frombuffer(bytes(row.bits), np.uint8)
    return out.tobytes()
