"""Benchmark decontamination by greedy string tiling.

A text and a benchmark item that share a seed of five words are tiled: running Karp-Rabin looks for
the longest matches of unmarked words, marks them and goes on with shorter ones, down to the seed's
length. Tiles don't overlap and may come in any order, so reordered passages count. A text leaks
an item when tiles cover at least COVERAGE of the item's words. An item of fewer words than a seed is
its own seed: it is leaked where it stands in a text as a whole. (shortest sets how many words an
item must have to be looked for at all; by default, one.)

Words are lower-cased runs of letters and digits; characters of scripts without spaces are words.
Items go to the executors in blocks of at most BLOCK_BYTES of text, each broadcast by itself. With
several blocks the corpus is read once for each, and only leaks are written.

Results for odd input: null and empty texts leak nothing; items of null text or id, or without
words, cannot be leaked; repeated rows give repeated results; items of equal text are each reported;
other columns come along, and one named like the result is replaced.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name, lean, saved, slices, table, text_key
from .words import lowered_words, windows

SEED, COVERAGE = 5, 0.8
BLOCK_BYTES, SLICE_BYTES = 16 << 20, 4 << 20
PRIME, RADIX = (1 << 61) - 1, 1_000_003


def _rolled(words: list[int], free: list[bool], k: int) -> Iterator[tuple[int, int]]:
    """Place and rolling hash of every window of k unmarked words."""
    h, run, drop = 0, 0, pow(RADIX, k, PRIME)
    for i, w in enumerate(words):
        if not free[i]:
            h = run = 0
            continue
        h = (h * RADIX + w) % PRIME
        run += 1
        if run > k:
            h = (h - words[i - k] * drop) % PRIME
        if run >= k:
            yield i - k + 1, h


def _runs(free: list[bool]) -> list[int]:
    """How many unmarked words there are from each place on."""
    out = [0] * (len(free) + 1)
    for i in range(len(free) - 1, -1, -1):
        out[i] = out[i + 1] + 1 if free[i] else 0
    return out


def _length(item: list[int], i: int, text: list[int], j: int, most: int) -> int:
    """How many words agree from places i and j on, at most: slices are compared, of twice the length
    each time, and then halved."""
    n, step = 0, 8
    while n < most:
        m = min(step, most - n)
        if item[i + n : i + n + m] == text[j + n : j + n + m]:
            n, step = n + m, 2 * step
        elif m == 1:
            break
        else:
            step = m // 2
            most = n + m - 1
    return n


def _matches(item: list[int], free_a: list[bool], text: list[int], free_b: list[bool], k: int) -> dict[int, list[tuple[int, int]]]:
    """Longest matches of at least k unmarked words, by length. Places are grouped by hash and by the
    word before, so that only pairs are looked at from which a match can't begin earlier."""
    before = lambda words, free, i: words[i - 1] if i and free[i - 1] else None
    places: dict[int, dict[int | None, list[int]]] = defaultdict(lambda: defaultdict(list))
    for i, h in _rolled(item, free_a, k):
        places[h][before(item, free_a, i)].append(i)
    found: dict[int, list[tuple[int, int]]] = defaultdict(list)
    if places:
        left_a, left_b = _runs(free_a), _runs(free_b)
        for j, h in _rolled(text, free_b, k):
            if h in places:
                own = before(text, free_b, j)
                for word, starts in places[h].items():
                    if word is None or word != own:
                        for i in starts:
                            n = _length(item, i, text, j, min(left_a[i], left_b[j]))
                            if n >= k:
                                found[n].append((i, j))
    return found


def tiles(item: list[int], text: list[int], least: int = SEED) -> list[tuple[int, int, int]]:
    """(place in item, place in text, words) of the tiles, longest first; of equally long ones the
    first in the item, then in the text. Words are numbers; those below 0 match nothing."""
    free_a, free_b = [w >= 0 for w in item], [w >= 0 for w in text]
    out: list[tuple[int, int, int]] = []
    k = max(least, min(len(item), 32))
    while True:
        found = _matches(item, free_a, text, free_b, k)
        longest = max(found, default=0)
        if longest > 2 * k:
            k = longest
            continue
        again = False
        left_a, left_b = _runs(free_a), _runs(free_b)
        for n in sorted(found, reverse=True):
            for i, j in sorted(found[n]):
                # all unmarked, and nothing was marked in there since
                if left_a[i] >= n and left_b[j] >= n and free_a[i] and free_b[j] and free_a[i + n - 1] and free_b[j + n - 1] and all(free_a[i : i + n]) and all(free_b[j : j + n]):
                    free_a[i : i + n] = free_b[j : j + n] = [False] * n
                    out.append((i, j, n))
                else:
                    again = True  # what is left of it may still be a match
        if again:
            continue
        if k == least:
            return out
        k = max(least, k // 2)


class Seeds:
    """Seeds of one length, with the items and places that they come from."""

    def __init__(self, length: int, words: np.ndarray, of: np.ndarray, items: np.ndarray):
        self.length = length
        seeds, first = windows(words, of, length)
        n = np.where(np.isin(np.arange(len(of) - 1), items), np.diff(first), 0)
        take = np.repeat(np.isin(np.arange(len(of) - 1), items), np.diff(first))
        seeds, owner = seeds[take], np.repeat(np.arange(len(of) - 1), n)
        place = np.arange(len(seeds)) - np.repeat(np.cumsum(n) - n, n)
        order = np.argsort(seeds, kind="stable")
        self.seeds, self.item, self.place = seeds[order], owner[order], place[order]
        self.bits = max(16, len(seeds).bit_length() + 4)
        self.some = np.zeros(1 << self.bits, bool)
        self.some[(seeds >> np.uint64(64 - self.bits)).astype(np.int64)] = True

    def hits(self, words: np.ndarray, of: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each text with seeds: text, places of seeds in it, which of its different seeds each is,
        and where entries of each different seed start and end."""
        grams, first = windows(words, of, self.length)
        may = np.flatnonzero(self.some[(grams >> np.uint64(64 - self.bits)).astype(np.int64)])
        lo, hi = (np.searchsorted(self.seeds, grams[may], side=s) for s in ("left", "right"))
        may, lo, hi = may[hi > lo], lo[hi > lo], hi[hi > lo]
        text = np.searchsorted(first, may, side="right") - 1
        cut = np.flatnonzero(np.diff(text)) + 1
        for at in np.split(np.arange(len(may)), cut) if len(may) else ():
            starts, back = np.unique(lo[at], return_inverse=True)
            ends = np.zeros(len(starts), np.int64)
            ends[back] = hi[at]
            yield int(text[at[0]]), may[at] - first[text[at[0]]], back, starts, ends


class Block:
    """Some benchmark items, with a table from seeds to the items that hold them."""

    def __init__(self, rows: list[tuple[int, str]], shortest: int = 1):
        self.ids = [i for i, _ in rows]
        self.words, self.of = lowered_words(pa.array([t for _, t in rows], pa.string()))
        size = np.diff(self.of)
        lengths = [k for k in range(max(1, shortest), SEED) if (size == k).any()] + [SEED]
        self.seeds = [Seeds(k, self.words, self.of, np.flatnonzero(size >= max(SEED, shortest) if k == SEED else size == k)) for k in lengths]

    def leaks(self, texts: pa.Array) -> list[list[tuple[int, float]]]:
        """For each text the items it leaks, with the share of words covered."""
        out: list[list[tuple[int, float]]] = [[] for _ in range(len(texts))]
        words, of = lowered_words(texts)
        for seeds in self.seeds:
            for t, places, seed, starts, ends in seeds.hits(words, of):
                # each different seed's entries once, however often the text has it
                n = ends - starts
                which = np.repeat(np.arange(len(n)), n)
                entry = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + starts[which]
                owner = seeds.item[entry]
                order = np.argsort(owner, kind="stable")
                cut = np.flatnonzero(np.diff(owner[order])) + 1
                own = words[of[t] : of[t + 1]]
                for part in np.split(order, cut):
                    m = int(owner[part[0]])
                    share = self._covered(m, seeds.length, seeds.place[entry[part]], own, places[np.isin(seed, which[part])])
                    if share >= COVERAGE:
                        out[t].append((self.ids[m], share))
        return [sorted(x) for x in out]

    def _covered(self, m: int, length: int, seen: np.ndarray, own: np.ndarray, places: np.ndarray) -> float:
        """Share of item m that tiles cover; seen: its places of shared seeds, places: the text's."""
        size = int(self.of[m + 1] - self.of[m])
        # no tiling covers more than the words that lie in some seed
        inside = np.zeros(size, bool)
        for d in range(length):
            inside[seen + d] = True
        if inside.sum() < COVERAGE * size:
            return 0.0
        item = (self.words[self.of[m] : self.of[m + 1]] >> np.uint64(4)).tolist()
        near = np.unique(places[:, None] + np.arange(length))
        gaps = np.flatnonzero(np.diff(near) > 1) + 1
        part = np.insert((own[near] >> np.uint64(4)).astype(np.int64), gaps, -1).tolist()
        return sum(n for _, _, n in tiles(item, part, length)) / size


_blocks: dict[tuple, Block] = {}


def _block(rows: list[tuple[int, str]], shortest: int, name: str) -> Block:
    """One block for each Python worker, kept until another is asked for."""
    if (name, shortest) not in _blocks:
        _blocks.clear()
        _blocks[name, shortest] = Block(rows, shortest)
    return _blocks[name, shortest]


KIND = "array<struct<item_id:bigint,coverage:double>>"


def _leaks_of(docs: DataFrame, block: list[tuple[int, str]], shortest: int, text_col: str, column: str) -> DataFrame:
    """docs with the leaks of one block in column, which docs has already, as an empty array."""
    sent, name = docs.sparkSession.sparkContext.broadcast(block), uuid.uuid4().hex
    names, kind = docs.columns, docs.schema
    at, into = names.index(text_col), names.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _block(sent.value, shortest, name)
        for batch in batches:
            start = 0
            for part in slices(batch.column(at), SLICE_BYTES):
                rows = batch.slice(start, len(part))
                start += len(part)
                found = [[{"item_id": i, "coverage": c} for i, c in x] for x in held.leaks(part)]
                columns = list(rows.columns)
                columns[into] = pa.array(found, rows.column(into).type)
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(lean(run), kind)


def find_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", column: str = "leaks", shortest: int = 1) -> DataFrame:
    """docs with an array of (item_id, coverage): the benchmark items that each row leaks."""
    docs = docs.drop(column)
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long"), "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # one item is in one block; blocks are even, as items are dealt out by their hash
    n = max(1, -(-total // BLOCK_BYTES))

    def block(k: int) -> list[tuple[int, str]]:
        rows = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        return sorted((r.item_id, r.text) for r in rows.collect())

    none = F.array().cast(KIND)
    if n == 1:
        return _leaks_of(docs.withColumn(column, none), block(0), shortest, text_col, column)
    texts = docs.select(F.col(f"`{text_col}`").alias("text")).where("text is not null").withColumn("leaks", none)
    found = None
    for k in range(n):
        part = _leaks_of(texts, block(k), shortest, "text", "leaks").where(F.size("leaks") > 0)
        part = saved(part.select(text_key(F.col("text")).alias("key"), F.explode("leaks").alias("leak")).distinct(), "leaks")
        found = part if found is None else found.union(part)
    key = free_name([*docs.columns, column], "leak_key")
    found = found.groupBy(F.col("key").alias(key)).agg(F.sort_array(F.collect_list("leak")).alias(column))
    out = docs.withColumn(key, text_key(F.col(f"`{text_col}`"))).join(found, key, "left").drop(key)
    return out.withColumn(column, F.coalesce(F.col(column), none))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, item_id and coverage of every leak."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    leaks = find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return leaks.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.item_id", "leak.coverage")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without the rows that leak a benchmark item; further columns, whatever their names, come
    along."""
    leaks = free_name(docs.columns, "found_leaks")
    found = find_leaks(docs, table(spark, sf_dir, "benchmark"), column=leaks)
    return found.where(F.size(leaks) == 0).select(*docs.columns)
