import random
from collections import defaultdict

import numpy as np
import pytest

from paperlode.llm import components, lines, packed


def shingle_set(x):
    return {x[i : i + lines.SHINGLE] for i in range(len(x) - lines.SHINGLE + 1)}


def brute(docs):
    """doc -> places of the lines that go; docs: (id, text) in order of precedence."""
    rows = [(d, i, x) for d, (_, t) in enumerate(docs) for i, x in lines.normal(t or "")]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    sets = [shingle_set(x) for *_, x in rows]
    for a in range(len(rows)):
        for b in range(a):
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                up[max(root(a), root(b))] = min(root(a), root(b))
    gone = defaultdict(list)
    for n, (d, i, _) in enumerate(rows):
        if root(n) != n:
            gone[d].append(i)
    return gone


@pytest.mark.parametrize("block", [128, 3])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(components, "BLOCK", block)
    monkeypatch.setattr(components, "FEW", block // 8)
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 8)))
    base = [" ".join(word() for _ in range(r.randint(6, 40))) for _ in range(25)]

    def line():
        x = r.choice(base)
        if r.random() < 0.5:
            ws = x.split()
            ws[r.randrange(len(ws))] = word()
            x = " ".join(ws)
        return x.upper() if r.random() < 0.2 else x

    docs = [(i, "\n".join(r.choice([line, line, word, lambda: ""])() for _ in range(r.randint(1, 8)))) for i in range(60)]
    want = brute(docs)
    rows = [(i, t, 7, "x") for i, t in docs] + [(None, None, 7, "x"), (99, "", 7, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, line int, node string")
    got = {x.doc_id: x for x in lines.dedup(df).collect()}
    missed = 0
    for i, t in docs:
        gone = got[i].dropped or []
        missed += len(set(gone) ^ set(want[i]))
        assert got[i].text == "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone)
    assert missed <= 2  # pairs near the threshold that share no bucket: under one in a hundred
    assert got[None].text is None and got[99].text == ""


def test_repeats_ties_nulls_and_empty(spark):
    same = "This very line stands here more than once"
    rows = [(2, f"{same}\nother words that stay here for good", 70), (1, same, 41), (1, same, 41), (None, same + "!", 42), (3, f"{same}\n{same}\n\n\n short", 90)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    out = sorted(map(str, map(tuple, lines.stage(spark, df, "").collect())))
    want = [(2, "other words that stay here for good", 35), (1, same, 41), (1, same, 41), (None, "", 0), (3, "\n\n short", 8)]
    assert out == sorted(map(str, want))
    assert lines.stage(spark, df.limit(0), "").count() == 0


def test_long_line_and_non_latin():
    long = "日本語のとても長い行です。" * 3000
    assert lines.signatures([long, long, "x" * 8]).shape == (3, lines.BANDS)
    x = lines.shingle_set(long.encode())
    assert lines.alike(x, x)
    assert x[0] is None
    r = random.Random(1)
    base = "".join(r.choice("crème brûlée at ono") for _ in range(200))
    latin = [lines.shingle_set(t.encode()) for t in (base, base + "日本語", "something else " * 9)]
    assert latin[0][0] is not None and lines.alike(latin[0], latin[1]) and not lines.alike(latin[0], latin[2])


def test_pairs_at_the_threshold_share_a_bucket():
    r = random.Random(8)
    word = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    pairs = [(x + word(10), x + word(10)) for x in (word(87) for _ in range(4000))]  # 80 of 100 shingles are shared
    one, two = (lines.signatures(list(x)) for x in zip(*pairs))
    assert (~(one == two).any(axis=1)).sum() <= 4


def test_short_lines_are_copies_too(spark):
    docs = [(1, "and ornd.\nok\n\n8 chars!"), (2, "And  ornd.\nok\n\nelse here"), (3, "8 chars!\nand orne.\nok")]
    out = {x.doc_id: x.text for x in lines.dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert out == {1: docs[0][1], 2: "ok\n\nelse here", 3: "and orne.\nok"}


def test_recall_by_similarity():
    r = random.Random(4)
    word = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    met, all_ = defaultdict(int), defaultdict(int)
    pairs = []
    for _ in range(4000):
        x = word(r.randint(40, 300))
        y = x
        for _ in range(r.randint(0, 3)):
            at = r.randrange(len(y))
            y = y[:at] + word(r.randint(0, 6)) + y[at + r.randint(0, 4) :]
        if len(y) >= lines.SHINGLE:
            pairs.append((x, y))
    one, two = (lines.signatures(list(x)) for x in zip(*pairs))
    for (x, y), hit in zip(pairs, (one == two).any(axis=1)):
        p, q = shingle_set(x), shingle_set(y)
        level = int(20 * len(p & q) / len(p | q) + 1e-9)
        if level >= 16:
            all_[level] += 1
            met[level] += bool(hit)
    assert len(all_) >= 4 and min(all_.values()) >= 20
    assert all(met[k] >= 0.995 * all_[k] for k in all_), (met, all_)


def test_clashing_columns_and_mixed_characters(spark):
    base = "the very same line stands here, again and again, in two documents"
    rows = [(1, base, "a", [1], 5), (2, base + "…", "b", None, 6), (3, base + "\n" + base, "c", [2], 7), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, dedup_key string, dropped_line_places array<int>, later int")
    got = {x.doc_id: tuple(x)[1:] for x in lines.stage(spark, df, "").collect()}
    assert got == {1: (base, "a", [1], 5), 2: ("", "b", None, 6), 3: ("", "c", [2], 7), None: (None, None, None, None)}


def test_query_equals_dedup(spark, tmp_path):
    rows = [(1, "one line that is there twice\nand one that is not"), (2, "One line that  is there twice"), (None, None)]
    spark.createDataFrame([(*x, "q") for x in rows], "doc_id long, text string, n_lines string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {x.doc_id: (x.n_lines, x.n_dropped, x.dropped) for x in lines.op3_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {1: (2, 0, None), 2: (1, 1, "0"), None: (1, 0, None)}


def test_two_of_three_are_linked_where_the_first_is_the_only_hub(spark):
    texts = {1: "nothing that the other two lines have", 2: "a line that stands here with a small change, one", 3: "a line that stands here with a small change, two"}
    # in bucket 7, 1 is both the one that meets most others and the one of least id
    members = spark.createDataFrame([(7, 1, 3, None), (7, 2, 3, None), (7, 3, 3, None), (8, 1, 9, None), (8, 4, 9, None)], "bucket long, id long, met long, other long")
    held = spark.createDataFrame([(i, bytes([i]), bytearray(t.encode())) for i, t in texts.items()], "id long, node binary, payload binary")
    met = components.met_by_id(members)
    got = components.near_components(members, met, lambda wanted: held.join(wanted, "id", "left_semi"), lines.MATCHER).collect()
    assert {bytes(x.node) for x in got} == {b"\x02", b"\x03"} and len({bytes(x.root) for x in got}) == 1


def test_small_buckets_come_as_pairs(spark, monkeypatch):
    buckets = {10: [1, 2], 20: [1, 2, 3], 30: [1, 2, 3, 4], 40: [5]}
    rows = spark.createDataFrame([(b, i) for b, ids in buckets.items() for i in ids], "bucket long, id long").coalesce(1)

    def sketch(batch):
        b, i = (c.to_numpy() for c in batch.columns)
        for k in range(len(b)):  # a run for each entry, so that none is known to be shared within it
            yield i[k : k + 1], (b[k : k + 1, None].astype(np.uint64) << np.uint64(33)) + np.uint64(1), i[:0]

    monkeypatch.setattr(packed, "RUN", 1)
    got = packed.shared_buckets(rows, sketch).collect()
    assert sorted((x.id, x.other) for x in got if x.other is not None) == [(1, 2), (1, 2), (1, 3), (2, 3)]
    assert sorted(x.id for x in got if x.bucket is not None) == [1, 2, 3, 4]


def test_pieces_change_no_bucket(monkeypatch):
    r = random.Random(3)
    some = ["".join(r.choice("abcdefgh é日") for _ in range(r.randint(8, 400))) for _ in range(60)]
    want = lines.signatures(some)
    monkeypatch.setattr(lines, "PIECE", 300)
    assert (lines.signatures(some) == want).all() and len(set(map(bytes, want))) == 60


def test_rarer_half_finds_all_near_ones():
    r = random.Random(12)
    base = [r.sample(range(400), r.randint(1, 60)) for _ in range(12)]
    sets = [set(r.sample(b, len(b) - r.randint(0, len(b) // 6))) | set(r.sample(range(400), r.randint(0, 3))) for b in base for _ in range(12)]
    common = components.Common([np.array(sorted(x), np.uint64) for x in sets])
    for k, x in enumerate(sets):
        assert {m for m, y in enumerate(sets) if 5 * len(x & y) >= 4 * len(x | y)} <= set(common.alike(k).tolist())
