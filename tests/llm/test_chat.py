import random

from paperlode.llm import chat


def plain(rows):
    """conv_id -> (turns, copies, text) of maximal conversations."""
    by = {}
    for c, t, r, x in rows:
        if c is not None:
            by.setdefault(c, []).append(((t is not None, t or 0), r or "", x or ""))
    full = {c: tuple((r, x) for _, r, x in sorted(v)) for c, v in by.items()}
    proper = {v[:i] for v in full.values() for i in range(1, len(v))}
    out = {}
    for c, v in full.items():
        same = [d for d in full if full[d] == v]
        if v not in proper and c == min(same):
            out[c] = (len(v), len(same), "".join(f"<|im_start|>{r}\n{x}<|im_end|>\n" for r, x in v))
    return out


def test_equals_plain_collapse(spark, monkeypatch):
    monkeypatch.setattr(chat, "CHUNK", 3)
    r = random.Random(2)
    rows = []
    for c in range(120):
        n = r.randint(1, 9)
        texts = [f"t{i}{r.choice(['', '', 'x'])}" for i in range(n)]
        rows += [(c, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(texts)]
    rows += [(500, None, None, None), (500, None, "user", ""), (500, 4, "user", "tie"), (500, 4, "user", "tie"), (500, -7, "a", "b"), (None, 1, "user", "nobody"), (None, 2, "user", "nobody")]
    df = spark.createDataFrame([(*x, "clash", 3) for x in rows], "conv_id long, turn long, role string, text string, rendered string, pos int")
    got = {x.conv_id: (x.n_turns, x.n_copies, x.rendered) for x in chat.format_chats(df).collect()}
    assert got == plain(rows)
    assert chat.format_chats(df.limit(0)).count() == 0


def test_long_conversation_and_empty_table(spark, tmp_path):
    turns = [(1, i, "user", f"turn {i}") for i in range(5000)] + [(2, i, "user", f"turn {i}") for i in range(4000)] + [(3, 0, "user", "long " * 100_000)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = {x.conv_id: (x.n_turns, len(x.rendered)) for x in chat.format_chats(df).collect()}
    assert set(got) == {1, 3} and got[1][0] == 5000 and got[3][1] > 500_000
    assert chat.format_chats(df.limit(0)).count() == 0
