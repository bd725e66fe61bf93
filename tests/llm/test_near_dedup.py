import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from paperlode.llm import components as c
from paperlode.llm import near_dedup as n


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row[:]
        for j, y in enumerate(b):
            row[j + 1] = last[j] + 1 if x == y else max(last[j + 1], row[j])
    return row[-1]


def grouped(pairs, nodes):
    up = {x: x for x in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        up[root(a)] = root(b)
    out = defaultdict(set)
    for x in nodes:
        out[root(x)].add(x)
    return sorted(map(sorted, out.values()))


@pytest.mark.parametrize("seed", range(4))
def test_banded_alignment_equals_plain_one(seed):
    r = random.Random(seed)
    for _ in range(300):
        a = [r.randint(0, r.choice([3, 60])) for _ in range(r.randint(1, 60))]
        b = [x for x in a if r.random() > 0.1]
        b = [r.randint(0, 60) if r.random() < 0.08 else x for x in b]
        m = lcs(a, b)
        assert n.aligned(a, b, len(a) + len(b)) == m
        want = bool(b) and 9 * m >= 4 * (len(a) + len(b))
        assert n.near(np.array(a, "<u4"), np.array(b, "<u4")) == want
    a = [1] * 900 + [2] * 50
    assert n.aligned(a, a[10:], 30) == 940


def edited(r, words, k):
    out = list(words)
    for _ in range(k):
        out[r.randrange(len(out))] = f"q{r.randint(0, 10**6)}"
    return out


def make(r, groups=25, copies=12):
    texts = []
    for _ in range(groups):
        base = [f"w{r.randint(0, 3000)}" for _ in range(r.randint(40, 160))]
        texts.append(" ".join(base))
        texts += [" ".join(edited(r, base, r.randint(0, 5))) for _ in range(r.randint(0, copies))]
    return texts


def test_classes_equal_brute_force(spark):
    r = random.Random(4)
    texts = make(r) + [None, "", "!!", "two words", "Two, words!", "x"]
    texts += texts[:20]
    df = spark.createDataFrame([(i, t, "clash", 5) for i, t in enumerate(texts)], "doc_id long, text string, node string, id int")
    grams, first = n.shingles(pa.array(texts))
    seq = [grams[a:b].tolist() for a, b in zip(first, first[1:])]
    pairs = [(i, j) for i in range(len(seq)) for j in range(i) if (texts[i] or "") == (texts[j] or "") or seq[i] and seq[j] and 9 * lcs(seq[i], seq[j]) >= 4 * (len(seq[i]) + len(seq[j]))]
    got = defaultdict(list)
    for row in n.near_duplicates(df).collect():
        got[row.class_id].append(row.doc_id)
    assert sorted(map(sorted, got.values())) == grouped(pairs, range(len(texts)))
    assert all(k == min(v) for k, v in got.items())


def test_large_group_needs_no_hub(spark, monkeypatch):
    """Copies that are near in a chain only: blocks find the links that two hubs miss."""
    monkeypatch.setattr(c, "BLOCK", 8)
    monkeypatch.setattr(c, "FEW", 3)
    r = random.Random(9)
    base = [f"w{i}" for i in range(200)]
    chain = [base]
    for _ in range(40):
        chain.append(edited(r, chain[-1], 2))
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(chain)], "doc_id long, text string")
    assert {x.class_id for x in n.near_duplicates(df).collect()} == {0}


def test_components(spark):
    r = random.Random(1)
    nodes = [r.getrandbits(60) for _ in range(300)]
    edges = [(nodes[i], nodes[i + 1]) for i in range(0, 99)] + [(nodes[100], x) for x in nodes[101:180]] + [(r.choice(nodes[180:]), r.choice(nodes[180:])) for _ in range(70)]
    rows = c.connected_components(spark.createDataFrame(edges + edges[:5] + [(None, 1)], "a long, b long")).collect()
    got = defaultdict(list)
    for x in rows:
        got[x.root].append(x.node)
    want = [g for g in grouped(edges, nodes) if len(g) > 1]
    assert sorted(map(sorted, got.values())) == want and Counter(x.node for x in rows).most_common(1)[0][1] == 1
    assert c.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_stage_keeps_one_of_each(spark):
    rows = [(3, "a b c d e f", "x"), (1, "A b c d e f.", "y"), (1, "A b c d e f.", "y"), (None, "other words entirely here now", "z"), (None, None, "n"), (7, "", "m")]
    df = spark.createDataFrame(rows, "doc_id long, text string, keeper string")
    kept = n.stage(spark, df, "")
    assert kept.columns == df.columns
    assert sorted(map(str, map(tuple, kept.collect()))) == sorted(map(str, [rows[1], rows[3], rows[5]]))
    assert n.stage(spark, df.limit(0), "").count() == 0


def test_recall_by_similarity():
    """Of pairs at each similarity from 0.8 on, nearly all share a bucket."""
    r = random.Random(11)
    pairs = []
    for _ in range(900):
        base = [f"w{r.randint(0, 10**6)}" for _ in range(r.randint(60, 300))]
        a, b = edited(r, base, r.randint(0, 3)), edited(r, base, r.randint(0, 5))
        pairs.append((" ".join(a), " ".join(b)))
    grams, first = n.shingles(pa.array([x for p in pairs for x in p]))
    buckets, seq = n.order_minhash(grams, first), [grams[a:b].tolist() for a, b in zip(first, first[1:])]
    met, all_ = Counter(), Counter()
    for k in range(len(pairs)):
        a, b = seq[2 * k], seq[2 * k + 1]
        m = lcs(a, b)
        level = int(m / (len(a) + len(b) - m) * 20 + 1e-9)
        if level >= 16:
            all_[level] += 1
            met[level] += bool((buckets[2 * k] == buckets[2 * k + 1]).any())
    assert len(all_) >= 4 and min(all_.values()) >= 5
    assert all(met[k] >= 0.98 * all_[k] for k in all_), (met, all_)


def test_stage_with_clashing_columns_and_a_very_long_text(spark):
    long = " ".join(f"w{i}" for i in range(120_000))
    rows = [(1, long, "k", 1, 2), (2, long + " end", "k", 1, 2), (3, "", "k", 1, 2), (4, None, None, None, None), (5, "x", "k", 1, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept_node string, least int, n_least int")
    assert sorted(map(str, map(tuple, n.stage(spark, df, "").collect()))) == sorted(map(str, [rows[0], rows[2], rows[4]]))


def test_query_gives_every_document(spark, tmp_path):
    r = random.Random(3)
    texts = make(r, 8, 4) + [None, ""]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {x.doc_id: x.class_id for x in n.op2_near_dedup(spark, str(tmp_path)).collect()}
    want = {x.doc_id: x.class_id for x in n.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == want and len(got) == len(texts) and got[len(texts) - 1] == len(texts) - 2


def test_packed_runs_find_all_shared_buckets(monkeypatch):
    """Members of shared buckets, whatever runs they stand in; ids that come again."""
    from paperlode.llm import packed

    monkeypatch.setattr(packed, "CHUNK", 3)
    r = np.random.default_rng(5)
    bands_of = {i: r.integers(0, 60, 4).astype(np.uint64) << np.uint64(30) for i in range(1, 80)}
    runs = [[int(i) for i in r.integers(1, 80, 25)] for _ in range(6)]
    rows = []
    for run in runs:
        ids = np.array(run, np.int64)
        rows += packed.packed_run(ids, np.array([bands_of[i] for i in run]), ids[:0], 3).to_pylist()
    by_part = defaultdict(list)
    for x in rows:
        by_part[x["part"]].append(tuple(x[c] for c in packed.FIELDS))
    got, again = set(), set()
    for part in by_part.values():
        for buckets, ids, _ in packed.shared_members(part):
            if buckets is None:
                again |= set(ids.tolist())
            else:
                got |= set(zip(buckets.tolist(), ids.tolist()))
    members = defaultdict(set)
    for i in {i for run in runs for i in run}:
        for b in packed.names_of(bands_of[i], 3).view(np.int64).tolist():
            members[b].add(i)
    count = Counter(i for run in runs for i in run)
    assert got == {(b, i) for b, x in members.items() if len(x) > 1 for i in x}
    assert again == {i for i, k in count.items() if k > 1}


def test_hot_keys_are_joined_like_others(spark):
    hot, keys = 3 * c.HOT, 2 * c.HOT  # one hot key, others with a row each, and some without a group
    rows = spark.range(hot + keys).selectExpr(f"if(id < {hot}, -1, id) as bucket", "id")
    groups = rows.groupBy("bucket").count().withColumnRenamed("count", "n").where("bucket % 5 <> 0").selectExpr("bucket", "bucket * 2 as twice", "n")
    got = c.spread_join(rows, groups, "bucket")
    want = rows.join(groups.drop("n"), "bucket")
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert c.spread_join(rows.limit(0), groups.limit(0), "bucket").count() == 0
