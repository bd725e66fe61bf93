import random

import numpy as np
import pytest

from paperlode.llm import topk


@pytest.mark.parametrize("seed", range(6))
def test_slices_equal_plain_products(seed):
    r = np.random.default_rng(seed)
    for _ in range(25):
        rows = r.integers(-9, 9, (int(r.integers(1, 150)), int(r.integers(1, 7)))) * int(r.choice([0, 1, 30]))
        s = topk.Slices.load(topk.Slices(rows).dump())
        q = r.integers(-300, 300, rows.shape[1]) * int(r.choice([0, 1]))
        k = int(r.integers(1, 8))
        own = r.random(len(rows)) < 0.1
        at, scores = s.best(q, k, s._bitmap(own))
        want = sorted((-int(x @ q), i) for i, x in enumerate(rows) if not own[i])[:k]
        assert sorted((-x, i) for i, x in zip(at.tolist(), scores)) == want


def brute(rows, k=topk.K):
    ok = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, a in ok:
        if i % topk.EVERY == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), j) for j, b in ok if j != i and len(a) == len(b))[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    return sorted(out)


def test_query_equals_brute_force(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(topk, "ROWS", 40)
    monkeypatch.setattr(topk, "QUERIES", 3)
    r = random.Random(3)
    rows = [(i, [r.choice([-0.5, 0.25, r.uniform(-1, 1)]) for _ in range(6)]) for i in range(400)]
    rows += [(i, rows[7][1]) for i in range(400, 460)]
    rows += [(1000, None), (1050, []), (1100, [None] * 6), (1150, [float("nan")] * 6), (1200, [float("inf")] * 6), (None, [1.0] * 6), (1250, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1, 5) for i, v in rows], "vec_id long, embedding array<float>, label int, score int")
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = sorted(map(tuple, topk.op1_top_k(spark, str(tmp_path)).collect()))
    assert got == brute(rows)
    df.limit(0).write.parquet(f"{tmp_path}/none/embeddings.parquet")
    assert topk.op1_top_k(spark, f"{tmp_path}/none").count() == 0


def test_large_components_and_copies_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "ROWS", 16)
    monkeypatch.setattr(topk, "QUERIES", 2)
    monkeypatch.setattr(topk, "GROUP", 2)
    r = random.Random(5)
    rows = [(i, [r.choice([0, 1, -3, 2**31, -(10**11), 2**62, -(2**63), r.randint(-(10**9), 10**9)]) for _ in range(4)]) for i in range(120)]
    rows += [(i, v) for i, v in rows[:7]]  # repeated rows: candidates each
    df = spark.createDataFrame(rows, "id long, vector array<long>")
    clip = lambda s: max(-(2**63), min(2**63 - 1, s))
    want = []
    for q in {i for i, _ in rows if i % 5 == 0}:
        best = sorted((-sum(x * y for x, y in zip(a, b)), j) for i, a in rows if i == q for j, b in rows if j != q)[:3]
        want += [(q, n + 1, j, clip(-s)) for n, (s, j) in enumerate(best)]
    got = topk.top_k(df, df.where("id % 5 = 0"), 3).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_query_with_components_beyond_32_bits(spark, tmp_path):
    rows = [(i, [1e8 if i == 3 else 0.5, float(i % 7), 1e300 if i == 9 else -1.0]) for i in range(120)]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = topk.op1_top_k(spark, str(tmp_path)).collect()
    q = lambda v: [max(-(2**63), min(2**63 - 1, int(np.floor(256 * x)) if abs(x) < 1e17 else 2**63)) for x in v]
    want = []
    for i, a in rows[::50]:
        best = sorted((-sum(x * y for x, y in zip(q(a), q(b))), j) for j, b in rows if j != i)[:5]
        want += [(i, n + 1, j, max(-(2**63), -s)) for n, (s, j) in enumerate(best)]
    assert sorted(map(tuple, got)) == sorted(want)
