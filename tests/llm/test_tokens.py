import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from paperlode.llm import bpe, token_counts

RAW = open(P.path("byte_bpe_50k.tiktoken"), "rb").read()
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, RAW.splitlines())}
ENC = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
rng = random.Random(5)
ODD = ["", " ", "\n\n x", "a" * 1500, "\x1c\x1d hi\x1f", "é" * 300, "it's  12345 ½ x y", "　日本語 test 😀😀", "<|endoftext|>", "ab" * 400 + " \n z"]
TEXTS = ODD + ["".join(rng.choice("thein ro's1\n.é日") for _ in range(rng.randint(0, 300))) for _ in range(400)]


def test_bpe_equals_library_and_round_trips():
    c = bpe.BytePairCoder(RAW, P.PATTERN)
    got = c.encode_batch(TEXTS)
    assert [bpe.np.frombuffer(x, "<u4").tolist() for x in got] == [ENC.encode_ordinary(t) for t in TEXTS]
    assert [c.decode(x) for x in got] == [t.encode() for t in TEXTS]


def test_matrix_and_heap_merge_alike():
    c = bpe.BytePairCoder(RAW, P.PATTERN)
    words = [bytes(rng.choice(b"thionesr") for _ in range(rng.randint(1, 60))) for _ in range(500)]
    assert c.merge_matrix(words) == [c.merge_long(w) for w in words]


def test_memory_that_overflows_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    c = bpe.BytePairCoder(RAW, P.PATTERN)
    for i in range(0, 100, 10):
        part = TEXTS[i : i + 10]
        assert [bpe.np.frombuffer(x, "<u4").tolist() for x in c.encode_batch(part)] == [ENC.encode_ordinary(t) for t in part]


def test_bpe_query_on_nulls_repeats_and_extra_columns(spark):
    rows = [(1, "hello there", 9), (1, "hello there", 9), (None, None, 9), (2, "", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    out = sorted(map(tuple, bpe.digests(df, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()), key=str)
    h = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for i, t, _ in rows:
        ids = ENC.encode_ordinary(t or "")
        want.append((i, len(ids), h(bpe.np.array(ids, "<u4").tobytes()), h((t or "").encode())))
    assert out == sorted(want, key=str)
    assert bpe.digests(df.limit(0), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0


def greedy(word: bytes, first: set, rest: set) -> int:
    n = i = 0
    while i < len(word):
        vocab = rest if i else first
        j = next((j for j in range(len(word), i, -1) if word[i:j] in vocab), None)
        if j is None:
            return 1
        n, i = n + 1, j
    return n


@pytest.mark.parametrize("seed", range(5))
def test_automaton_equals_greedy_longest_match(seed):
    r = random.Random(seed)
    word = lambda n: bytes(r.choice(b"abc") for _ in range(r.randint(1, n)))
    first, rest = {word(5) for _ in range(12)}, {word(5) for _ in range(12)}
    m = token_counts.LongestMatch(first, rest)
    for w in [word(14) for _ in range(2000)]:
        assert m.word(w) == greedy(w, first, rest), (w, first, rest)


def test_token_counts_with_the_public_vocabulary(spark):
    first, rest = token_counts.pieces_of_ranks(RAW)
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*TEXTS[:60], None])], "doc_id long, text string")
    got = dict(token_counts.count_tokens(df, P.path("byte_bpe_50k.tiktoken")).collect())
    assert got == {i: sum(greedy(w.encode(), first, rest) for w in token_counts.WORDS.findall(t or "")) for i, t in enumerate([*TEXTS[:60], None])}


def test_queries_take_odd_rows_and_empty_tables(spark, tmp_path):
    from paperlode.llm import bpe, token_counts

    rows = [(1, "a text of some words", 1, b"x"), (1, "a text of some words", 1, b"x"), (None, None, None, None), (2, "", 0, b""), (3, "long " * 60_000 + "x" * 70_000, 5, b"y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, ids binary")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    df.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    for query in (bpe.op8_bpe, token_counts.op5_token_counts):
        out = query(spark, str(tmp_path)).collect()
        got = {x.doc_id: x.n_tokens for x in out}
        assert len(out) == 5 and got[1] > 3 and got[None] == got[2] == 0 and got[3] > 60_000
        assert query(spark, f"{tmp_path}/none").count() == 0
