"""Near-duplicate linking: candidates from shared buckets, exact tests, connected components.

Used with any sketch: the caller brings the members of shared buckets and a Matcher.

1. Two members of a bucket are its hubs: the one that meets most others over all its buckets (in a
   group of copies, mostly the text they were made from), and the one of least id. All other
   members are tested against them. A hub's pairs come together with one copy of its payload.
   Buckets of two and three come as their pairs, which are tested in the same way.
2. Links so far are contracted to components. In a bucket that still holds several, its largest one
   and the rest are cut into blocks; a block of the rest meets each block of the largest one and
   of the rest. A block pair counts what its payloads have in common with an inverted index and
   tests pairs of different components only, as a local union-find goes on. So no link between
   components of a bucket is lost, and what comes out is a forest, never all pairs of a group.
   Rows: each member of the largest component once for each block of the rest, mostly one.
   What a bucket or hub has is joined to its rows where they are, if it is a hot one, so that no
   task gets all of them.
3. Components of all links: each node hooks onto its smallest neighbour, two steps at a time, and
   edges are rewritten until none is left. All state is in tables in the shared folder.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import distilled, lean, release, saved, shuffle_partitions

#: Members and bytes of payloads in a block, rows of two blocks up to which no index is made, members
#: of a hub that one task tests in one go, and entries of the index that are counted in one go.
BLOCK, BLOCK_BYTES, FEW, FANS, ENTRIES = 4096, 8 << 20, 16, 1024, 1 << 21
#: A key of more than one HOTth of the rows is hot. There are less than HOT of these at any size.
HOT = 4096


@dataclass
class Matcher:
    """How two payloads are compared.

    prepare makes a payload ready for test, which says whether two that are ready are near
    duplicates. features gives the different features of a payload, as 64-bit numbers: where n and
    m features have o in common, near duplicates always have o / (n + m - o) >= 4 / 5.
    """

    prepare: Callable
    test: Callable
    features: Callable


def connected_components(edges: DataFrame) -> DataFrame:
    """node and root for every node in edges (a, b); root is a node of the same component.

    Null ends don't count. Works with any type that has an order; node keys should be hashes, as
    hooking onto the smallest neighbour then takes a logarithmic number of rounds.
    """
    e = edges.where("a is not null and b is not null").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    e = saved(e.where("a <> b").distinct(), "edges")
    labels = None
    while True:
        ends = e.select(F.col("a").alias("node")).union(e.select("b")).distinct()
        if labels is None:
            first = ends
        if e.isEmpty():
            break
        hook = e.groupBy("a").agg(F.min("b").alias("b"))
        twice = hook.alias("x").join(hook.select(F.col("a").alias("b"), F.col("b").alias("c")), "b", "left")
        step = saved(twice.select("a", F.coalesce("c", "b").alias("to")), "hooks")
        labels = (
            first.join(step.withColumnRenamed("a", "node"), "node", "left").select("node", F.coalesce("to", "node").alias("root"))
            if labels is None
            else labels.join(step.withColumnRenamed("a", "root"), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
        )
        labels = saved(labels, "labels")
        e = (
            e.join(step, "a").select(F.col("to").alias("a"), "b")
            .join(step.select(F.col("a").alias("b"), F.col("to").alias("to_b")), "b", "left")
            .select("a", F.coalesce("to_b", "b").alias("b"))
            .where("a <> b")
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            .distinct()
        )
        e = saved(e, "edges")
    return labels if labels is not None else first.select("node", F.col("node").alias("root"))


def _starred(stars: DataFrame, matcher: Matcher) -> DataFrame:
    """a and b of the links between a hub and its members. stars: hub, salt, fan (false for the hub's
    own row), node and payload, sorted by the first three."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, hubs = None, []
        for batch in batches:
            links = []
            for hub, salt, fan, node, payload in zip(*(c.to_pylist() for c in batch.columns)):
                if (hub, salt) != key:
                    key, hubs = (hub, salt), []
                ready = matcher.prepare(payload)
                if not fan:
                    hubs.append((node, ready))  # should two nodes have one id, each of them is tested
                else:
                    links += [(node, x) for x, y in hubs if x != node and matcher.test(ready, y)]
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*links)], ["a", "b"])

    return stars.select("hub", "salt", "fan", "node", "payload").mapInArrow(lean(run), "a binary, b binary")


class Common:
    """An inverted index of the features of some payloads."""

    def __init__(self, features: list[np.ndarray]):
        self.size = np.array([len(f) for f in features])
        owner = np.repeat(np.arange(len(features)), self.size)
        values = np.concatenate(features)
        order = np.argsort(values)
        values = values[order]
        new = np.concatenate([[True], values[1:] != values[:-1]])
        self.codes, self.first = np.empty(len(values), np.int64), np.concatenate([[0], np.cumsum(self.size)])
        self.codes[order] = np.cumsum(new) - 1
        self.owner = owner[order]
        self.start = np.append(np.flatnonzero(new), len(values))

    def alike(self, k: int) -> np.ndarray:
        """The others that can have enough in common with k, most first. Only the rarer half of k's
        features is counted: those that k and another don't share may all be of that half, no more."""
        codes = self.codes[self.first[k] : self.first[k + 1]]
        start, size = self.start[codes], self.start[codes + 1] - self.start[codes]
        left_out = len(codes) // 2
        if left_out:
            rare = np.argpartition(size, len(codes) - left_out - 1)[: len(codes) - left_out]
            codes, start, size = codes[rare], start[rare], size[rare]
        total, held = np.cumsum(size), 0
        both = np.zeros(len(self.size), np.int64)
        at = 0
        while at < len(codes):
            end = max(at + 1, int(np.searchsorted(total, held + ENTRIES, side="right")))
            n = size[at:end]
            skip = np.repeat(start[at:end] - (np.cumsum(n) - n), n)
            both += np.bincount(self.owner[skip + np.arange(len(skip))], minlength=len(both))
            at, held = end, int(total[end - 1])
        found = np.flatnonzero(9 * (both + left_out) >= 4 * (self.size + self.size[k]))
        return found[np.argsort(-both[found], kind="stable")]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """x and the rows (rest, root, payload) of each (bucket, x, y) of sorted batches."""
    key, rows = None, []
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for k, row in zip(zip(*columns[:3]), zip(*columns[3:])):
            if k != key:
                if rows:
                    yield key[1], rows
                key, rows = k, []
            rows.append(row)
    if rows:
        yield key[1], rows


def block_links(rows: list[tuple], inner: bool, matcher: Matcher) -> list[tuple[bytes, bytes]]:
    """Pairs of roots whose components a link joins, of rows (rest, root, payload): of each row of the
    rest with those that aren't, and if inner with others of the rest."""
    rest, roots, payloads = zip(*rows)
    number: dict[bytes, int] = {}
    own = np.array([number.setdefault(r, len(number)) for r in roots])
    if len(number) == 1:
        return []
    # an index pays where it spares many tests
    common = Common([matcher.features(p) for p in payloads]) if len(rows) > FEW else None
    ready = functools.cache(lambda k: matcher.prepare(payloads[k]))
    links = []
    for k in np.flatnonzero(rest).tolist():
        found = np.arange(len(rows)) if common is None else common.alike(k)
        for m in found[own[found] != own[k]].tolist():
            if own[m] != own[k] and (not rest[m] or (inner and m < k)) and matcher.test(ready(m), ready(k)):
                links.append((roots[m], roots[k]))
                own[own == own[m]] = own[k]
    return links


def _between_blocks(matcher: Matcher) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, rows in _groups(batches):
            if links := block_links(rows, x == 0, matcher):
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*links)], ["a", "b"])

    return run


def met_by_id(members: DataFrame) -> DataFrame:
    """id and met of every member: how many others it meets over all its buckets."""
    others = members.where("other is not null").select(F.col("other").alias("id"), "met")
    return saved(members.select("id", "met").union(others).groupBy("id").agg(F.sum("met").alias("met")), "met")


def near_components(members: DataFrame, met: DataFrame, payloads: Callable[[DataFrame], DataFrame], matcher: Matcher) -> DataFrame:
    """node and root of every node that is linked to another.

    members: bucket and id, or id and other, of what shares buckets (shared_buckets). met: met_by_id of them. payloads: gives id, node (binary key, of
    which id is a hash) and payload (binary) for the ids of a DataFrame, one row a node.
    """
    return distilled(members.sparkSession, "roots", lambda: _near_components(members, met, payloads, matcher))


def spread_join(rows: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """rows and what groups, a saved table with one row for each key, says of theirs. n of groups is
    how many rows there are of a key; those of hot keys stay where they are, as the less than HOT
    groups that can be hot are broadcast."""
    total = groups.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") * HOT > total
    few, many = groups.where(~hot).drop("n"), F.broadcast(groups.where(hot).drop("n"))
    return rows.join(many, key).unionByName(rows.join(many, key, "left_anti").join(few, key))


def _hub_links(members: DataFrame, hubs: DataFrame, couples: DataFrame, held: DataFrame, matcher: Matcher) -> DataFrame:
    pairs = spread_join(members, hubs, "bucket").select("id", F.explode(F.array_distinct(F.array("hub", "second"))).alias("hub")).where("id <> hub")
    # a pair of hubs is tested once
    pairs = pairs.select(F.least("id", "hub").alias("id"), F.greatest("id", "hub").alias("hub"), (F.col("id") < F.col("hub")).alias("up"))
    pairs = saved(pairs.union(couples.select("id", "other", F.lit(True))).groupBy("id", "hub").agg(F.max("up").alias("up")), "pairs")
    pairs = pairs.select(F.when(F.col("up"), F.col("id")).otherwise(F.col("hub")).alias("id"), F.when(F.col("up"), F.col("hub")).otherwise(F.col("id")).alias("hub"))
    tasks = saved(pairs.groupBy("hub").agg(F.ceil(F.count("*") / FANS).cast("int").alias("salts"), F.count("*").alias("n")), "hubs")
    fans = spread_join(pairs, tasks, "hub").join(held, "id").select("hub", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int").alias("salt"), F.lit(True).alias("fan"), "node", "payload")
    own = tasks.join(held.withColumnRenamed("id", "hub"), "hub").select("hub", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(False).alias("fan"), "node", "payload")
    stars = fans.union(own).repartition(shuffle_partitions(members.sparkSession), "hub", "salt").sortWithinPartitions("hub", "salt", "fan")
    return saved(_starred(stars, matcher), "links")


def _block_rows(members: DataFrame, hubs: DataFrame, held: DataFrame, joined: DataFrame) -> DataFrame:
    """bucket, x, y, rest, root and payload: what block x of a bucket's largest component (or,
    below 0, block -1 - x of its rest) and block y of its rest hold."""
    names = held.select("id", "node", F.octet_length("payload").alias("size")).join(joined, "node", "left").select("id", F.coalesce("root", "node").alias("root"), "size")
    # hubs were tested against all; of three members, two of which are hubs, nothing else is left
    open_ = spread_join(members, hubs.where("n > 3 or n = 3 and hub = second"), "bucket").where("id <> hub and id <> second").select("bucket", "id").join(names, "id")
    open_ = saved(open_.select("bucket", "id", "root", "size"), "open")
    kinds = open_.groupBy("bucket", "root").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    mixed = kinds.groupBy("bucket").agg(F.max(F.struct("n", "size", "root")).alias("most"), F.sum("n").alias("n"), F.sum("size").alias("size"), F.count("*").alias("kinds")).where("kinds > 1")
    blocks = lambda n, size: F.greatest(F.ceil(n / BLOCK), F.ceil(size / BLOCK_BYTES)).cast("int")
    most = F.col("most")
    mixed = mixed.select("bucket", most["root"].alias("main"), blocks(most["n"], most["size"]).alias("xs"), blocks(F.col("n") - most["n"], F.col("size") - most["size"]).alias("ys"), "n")
    rows = spread_join(open_, saved(mixed, "mixed"), "bucket").withColumn("rest", F.col("root") != F.col("main"))
    own = F.pmod(F.xxhash64("id", F.lit(7)), F.when(F.col("rest"), F.col("ys")).otherwise(F.col("xs"))).cast("int")
    row = lambda x, y, rest: F.struct(x.cast("int").alias("x"), y.cast("int").alias("y"), rest.alias("rest"))
    upto = lambda n: F.slice(F.sequence(F.lit(0), n), F.lit(1), n)  # noqa: E731  0 to n - 1
    main = F.transform(upto(F.col("ys")), lambda y: row(F.col("own"), y, F.lit(False)))
    rest = F.concat(
        F.transform(upto(F.col("xs")), lambda x: row(x, F.col("own"), F.lit(True))),
        F.transform(upto(F.col("own")), lambda x: row(-1 - x, F.col("own"), F.lit(True))),
        F.transform(F.slice(upto(F.col("ys")), F.col("own") + 2, F.col("ys")), lambda y: row(-1 - F.col("own"), y, F.lit(False))),
    )
    rows = rows.withColumn("own", own).select("bucket", "id", "root", F.explode(F.when(F.col("rest"), rest).otherwise(main)).alias("at"))
    return rows.join(held, "id").select("bucket", "at.x", "at.y", "at.rest", "root", "payload")


def _near_components(members: DataFrame, met: DataFrame, payloads: Callable[[DataFrame], DataFrame], matcher: Matcher) -> DataFrame:
    spark = members.sparkSession
    held = saved(payloads(met.select("id")), "payloads")
    release(spark)
    couples, members = members.where("other is not null"), members.where("bucket is not null").select("bucket", "id")
    # which of two that meet as many is the hub makes no difference to the result
    hubs = members.join(met, "id").groupBy("bucket").agg(F.max_by("id", "met").alias("hub"), F.min("id").alias("second"), F.count("*").alias("n"))
    hubs = saved(hubs, "tops")
    links = _hub_links(members, hubs, couples, held, matcher)
    joined = connected_components(links)
    left = _block_rows(members, hubs, held, joined).repartition(shuffle_partitions(spark), "bucket", "x", "y").sortWithinPartitions("bucket", "x", "y", "root")
    # what blocks link are components, so only those are joined once more
    top = connected_components(saved(left.mapInArrow(lean(_between_blocks(matcher)), "a binary, b binary"), "links"))
    top = top.select(F.col("node").alias("root"), F.col("root").alias("top"))
    alone = top.join(joined.select(F.col("node").alias("root")), "root", "left_anti").select(F.col("root").alias("node"), F.col("top").alias("root"))
    return joined.join(top, "root", "left").select("node", F.coalesce("top", "root").alias("root")).union(alone)
