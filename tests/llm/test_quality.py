import zlib

import numpy as np
import pyarrow as pa
import pytest

from paperlode.llm import quality as q
from paperlode.llm import words


def plain(text):
    """STATS of one text, counted one by one."""
    b = (text or "").encode()
    ws = b.split()
    n, k = max(1, len(b)), max(1, len(ws))
    share = lambda chars: sum(c in chars.encode() for c in b) / n
    return [
        len(b), len(ws), sum(map(len, ws)) / k, share("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), share("0123456789"), share("#$%&*+<=>@[]\\^_`{}~"), share("|"), share("!"), share(".,;:?"),
        len(b) / (1 + b.count(b"\n")), len(set(ws)) / k, sum(x == y for x, y in zip(ws, ws[1:])) / k, max((ws.count(x) for x in set(ws)), default=0) / k,
    ]


def test_statistics_equal_plain_counts():
    texts = ["", None, "a a b\nc", "é È | x!! 12 $", "end ", " start", "x" * 3000, "Der Der Der das.", "\n\n"]
    got = np.concatenate([q.statistics(p) for p in q.slices(pa.array(texts), 20)])
    assert np.allclose(got, [plain(t) for t in texts])


def test_words_and_windows_do_not_cross_texts():
    h, at = words.lowered_words(pa.array(["Ab c-d", "", None, "AB", "c d e"]))
    assert at.tolist() == [0, 3, 3, 3, 4, 7] and h[0] == h[3] and h[1] == h[4] and h[2] == h[5]
    g, of = words.windows(h, at, 2)
    assert of.tolist() == [0, 2, 2, 2, 2, 4] and g[1] == g[2]


def test_fit_learns_a_conjunction_and_column_agrees(spark):
    rng = np.random.default_rng(3)
    x = rng.random((3000, len(q.STATS)))
    y = ((x[:, 3] > 0.4) & (x[:, 6] <= 0.7)).astype(float)
    m = q.fit(x[:2000], y[:2000])
    df = spark.createDataFrame([list(map(float, r)) for r in x[2000:]], ", ".join(f"{s} double" for s in q.STATS))
    p = np.array([r[0] for r in df.select(m.column()).collect()])
    assert ((p > 0.5) == (y[2000:] == 1)).mean() > 0.97
    assert 0 < len(m.rules) < 300


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(None, None, None)]])
def test_few_labels_and_odd_rows(spark, labels):
    docs = spark.createDataFrame([(1, "a b c", 1.0), (None, None, 2.0), (1, "a b c", 1.0)], "doc_id long, text string, n_words double")  # a column named like a statistic
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = q.score_documents(docs, lab).collect()
    assert len(out) == 3 and all(0 <= r.score <= 1 for r in out)
    assert q.score_documents(docs.limit(0), lab).count() == 0


def test_stage_keeps_columns_and_held_out_is_crc32(spark, tmp_path):
    rows = [(i, ("good clean words here. " if i % 2 else "$$$ ### %%% &&& ") * (3 + i % 5), "en", "s", i) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score int")
    spark.createDataFrame([(i, i % 2, 0) for i in range(200)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = q.stage(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(200) if i % 2]
    flags = {r.doc_id: r.h for r in docs.select("doc_id", q.held_out(docs.doc_id).alias("h")).collect()}
    assert flags == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(200)}


def test_stage_with_clashing_columns_and_empty_tables(spark, tmp_path):
    rows = [(i, "plain words that make a text " * (1 + i % 4) if i % 2 else "|| ## 99 " * 9, i, i, str(i), 0.5) for i in range(120)] + [(None, None, 1, 2, None, 0.1)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, digits int, N_Words int, scored_text string, kept_1 double")
    spark.createDataFrame([(i, i % 2, 0) for i in range(120)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = q.stage(spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    got = [tuple(r) for r in out.collect()]
    assert [r for r in got if r[0] is not None] == [r for r in rows[:120] if r[0] % 2]
    assert got.count(rows[-1]) in (0, 2)  # repeated rows get one score
    assert q.stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_held_out_rows_are_told_apart(spark):
    """Labels of rows whose crc32 modulo 5 is 0 are never learned from; the score still knows them."""
    r = np.random.default_rng(2)
    word = lambda: "".join(r.choice(list("abcdefghijklmnop"), int(r.integers(2, 9))))
    good = lambda: ". ".join(" ".join(word() for _ in range(int(r.integers(5, 12)))).capitalize() for _ in range(int(r.integers(2, 9))))
    junk = [lambda: " ".join(["buy"] * 40), lambda: "| " * 30 + word(), lambda: "CLICK HERE!!! " * 9, lambda: "\n".join(str(x) for x in r.integers(0, 10**6, 30))]
    rows = [(i, good() if i % 2 else junk[i // 2 % 4](), i % 2) for i in range(600)]
    docs = spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string")
    held = {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    lied = [(i, 1 - y if i in held else y, 0) for i, _, y in rows]  # wrong where no one may look
    got = {x.doc_id: x for x in q.score_documents(docs, spark.createDataFrame(lied, "doc_id long, quality int, toxic int")).collect()}
    assert sum(got[i].predicted == y for i, _, y in rows if i in held) >= 0.97 * len(held)
    scores = sorted((got[i].score, y) for i, _, y in rows if i in held)
    ranks = [k for k, (_, y) in enumerate(scores) if y]
    n, m = len(ranks), len(scores) - len(ranks)
    assert (sum(ranks) - n * (n - 1) / 2) / (n * m) > 0.98  # area under the curve
