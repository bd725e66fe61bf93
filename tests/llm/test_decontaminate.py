import random
import re
import time

import pyarrow as pa
import pytest

from paperlode.llm import decontaminate as d


def plain_tiles(a, b, least):
    """Greedy string tiling as first published: the longest match anywhere, again and again."""
    free_a, free_b, total = [True] * len(a), [w >= 0 for w in b], []
    while True:
        best = (least - 1, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and free_a[i + n] and free_b[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return total
        free_a[i : i + n] = free_b[j : j + n] = [False] * n
        total.append(n)


@pytest.mark.parametrize("seed", range(6))
def test_tiles_equal_plain_tiling(seed):
    r = random.Random(seed)
    for _ in range(60):
        a = [r.randint(0, 3) for _ in range(r.randint(1, 24))]
        b = [r.choice([*a, 9]) for _ in range(r.randint(0, 20))]
        i = r.randint(0, len(a))
        b += a[i:] + a[:i]
        got = d.tiles(a, b, 2)
        assert all(a[i : i + n] == b[j : j + n] for i, j, n in got)
        assert len({x for i, _, n in got for x in range(i, i + n)}) == sum(n for *_, n in got)
        assert [n for *_, n in got] == plain_tiles(a, b, 2)  # whole tilings, longest first


def test_whole_reordered_and_partial_passages():
    r = random.Random(1)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    item = [word() for _ in range(40)]
    other = lambda n: " ".join(word() for _ in range(n))
    moved = item[25:] + item[:12] + item[12:25]
    texts = [
        f"{other(50)} {' '.join(item)} {other(9)}", f"{' '.join(moved[:15])}\n{other(30)}. {' '.join(moved[15:]).upper()}", f"{other(4)} {' '.join(item[:20])} {other(30)}", other(100), "", None,
        " ".join(" ".join(item) for _ in range(3)),
    ]
    got = d.Block([(7, " ".join(item)), (8, " ".join(item)), (9, other(30)), (10, "a b")]).leaks(pa.array(texts))
    assert [[i for i, _ in x] for x in got] == [[7, 8], [7, 8], [], [], [], [], [7, 8]]  # item 10, "a b", stands nowhere
    assert all(c == 1 for x in (got[0], got[1], got[6]) for _, c in x)


def test_blocks_change_nothing(spark, monkeypatch):
    r = random.Random(2)
    items = [(i, " ".join(f"w{r.randint(0, 500)}" for _ in range(20))) for i in range(12)] + [(None, "a b c d e f"), (50, None)]
    docs = [(i, f"x y {items[i % 12][1]} z" if i % 3 else "nothing here", "clash") for i in range(30)] + [(None, None, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string, item_id string")
    want = sorted((i, i % 12) for i, *_ in docs[:-1] if i % 3)
    for size in (d.BLOCK_BYTES, 400):
        monkeypatch.setattr(d, "BLOCK_BYTES", size)
        out = d.find_leaks(df, bench)
        assert sorted((x.doc_id, y.item_id) for x in out.collect() for y in x.leaks) == want
    assert d.find_leaks(df.limit(0), bench).count() == 0
    assert d.find_leaks(df, bench.limit(0)).count() == 31


def test_stage_drops_leaks_only(spark, tmp_path):
    spark.createDataFrame([(1, "one two three four five six seven")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(1, "x One two three four five, six seven!", "a"), (2, "one two three", "b"), (3, None, None)], "doc_id long, text string, leaks string")
    out = d.stage(spark, docs, str(tmp_path))
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == [2, 3]


def brute_leaks(items, texts):
    """Coverage of plain tilings of whole texts by whole items, where it is enough."""
    split = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    number: dict = {}
    code = lambda t: [number.setdefault(w, len(number)) for w in split(t)]
    out = []
    for t in texts:
        found = []
        for i, x in items:
            item = code(x)
            share = sum(plain_tiles(item, code(t), min(d.SEED, len(item)))) / len(item) if item else 0
            if share >= d.COVERAGE:
                found.append((i, share))
        out.append(found)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_coverage_equals_plain_tiling(seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(r.choice([4, 30]))]
    items = [(i, " ".join(r.choice(words) for _ in range(r.randint(0, 18)))) for i in range(25)]
    texts = []
    for _ in range(40):
        x = r.choice(items)[1].split()
        k = r.randint(0, len(x))
        x = x[k:] + ["zz"] * r.randint(0, 1) + x[:k]
        if x and r.random() < 0.5:
            x[r.randrange(len(x))] = "other"
        texts.append(" ".join([r.choice(words) for _ in range(r.randint(0, 6))] + x))
    got = d.Block(items).leaks(pa.array(texts))
    assert [[(i, round(c, 9)) for i, c in x] for x in got] == [[(i, round(c, 9)) for i, c in x] for x in brute_leaks(items, texts)]


def test_short_items_and_repetitive_texts():
    block = d.Block([(1, "four words stand here"), (2, "one"), (3, "")])
    assert [[i for i, _ in x] for x in block.leaks(pa.array(["so Four words, stand here!", "four words stand", "one day"]))] == [[1], [], [2]]
    assert d.Block([(1, "four words stand here"), (2, "one")], shortest=5).leaks(pa.array(["four words stand here one"])) == [[]]
    items = [(i, " ".join(["same"] * (20 + i))) for i in range(20)] + [(99, " ".join(["a", "b"] * 700))]
    began = time.time()
    got = d.Block(items).leaks(pa.array([" ".join(["same"] * 6000), " ".join(["a", "b"] * 3000)]))
    assert [len(x) for x in got] == [20, 1] and time.time() - began < 10


def test_other_scripts_and_quotes():
    item = "日本語のとても長い質問の文です"
    block = d.Block([(1, item), (2, "which of these “quoted” words is the right answer")])
    texts = [f"前置き{item}。終わり", "xx which\u00a0of these quoted words — is the right answer yy", "日本"]
    assert [[i for i, _ in x] for x in block.leaks(pa.array(texts))] == [[1], [2], []]
    assert block.leaks(pa.array(["é", "…", "x" * 10 + "\u00a0"])) == [[], [], []]


def test_stage_with_clashing_columns_and_very_long_text(spark, tmp_path):
    leak = " ".join(f"q{i}" for i in range(30))
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, "word " * 200_000 + leak, "a", 1), (2, "clean", "b", 2), (2, "clean", "b", 2), (None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, found_leaks string, leak_key int")
    assert sorted(map(str, map(tuple, d.stage(spark, docs, str(tmp_path)).collect()))) == sorted(map(str, rows[1:]))
