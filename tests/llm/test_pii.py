import hashlib
import random
import re
from collections import Counter, defaultdict
from math import log2

from paperlode.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def base(text):
    out = {}
    for kind, p in PLAIN.items():
        out[kind] = []
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) < 256 for x in m[0].split(".")) if kind == "ip" else 0, "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]
            if ok:
                out[kind].append((m.start(), m.end(), m[0]))
    return out


r = random.Random(3)
ODD = [
    None, "", "a@b.c_d@e.f x@y@z.com a.b@c-d.e.. é@x.y", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.0004 1.2.3", "4111 1111 1111 1111 x 4111-1111-1111-1111-1 4111  1111",
    "+1 (386) 555-3733, +12 +1234567 8 (0) .", "é😀 +44 20 7946 0958 ü a@b.co", "1" * 5000, "9 " * 5000, "a" * 5000 + "@", "a@b.c " * 1500, "+1" * 3000,
]
ODD += ["".join(r.choice("ab1209.@+- ()é\n") for _ in range(r.randint(0, 120))) for _ in range(500)]


def test_base_spans_equal_plain_patterns(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    for row in pii.find_personal_data(df).collect():
        want = base(ODD[row.doc_id] or "")
        assert {k: [tuple(x) for x in row[k]] for k in pii.KINDS} == want, ODD[row.doc_id]


def brute_terms(docs):
    found = {d: base(t or "") for d, t in docs}
    n, n_e, n_t, n_et, ctx = len(docs), Counter(), Counter(), Counter(), {}
    for d, t in docs:
        t = t or ""
        spans = [(s, e, f"{k}:{m}") for k in pii.KINDS for s, e, m in found[d][k]]
        n_e.update({x[2] for x in spans})
        words = [(m.start(), m.end(), m[0].lower()) for m in re.finditer(r"[^\W\d_]{3,}", t)]
        n_t.update({w for *_, w in words})
        ctx[d] = set()
        for s, e, name in spans:
            for a, b, w in words:
                # whole runs of letters inside the window, or up to its inner side
                if (b <= s and a >= max(0, s - pii.WINDOW) and (a > s - pii.WINDOW or s <= pii.WINDOW)) or (a >= e and b <= min(len(t), e + pii.WINDOW) and (b < e + pii.WINDOW or e + pii.WINDOW >= len(t))):
                    if not any(a < y and b > x for x, y, _ in spans):
                        ctx[d].add((name, w, a, b))
        n_et.update({x[:2] for x in ctx[d]})
    out = defaultdict(dict)
    for d, c in ctx.items():
        for name, w, a, b in c:
            if n_et[name, w] >= pii.SUPPORT and log2(n / n_e[name]) > 0:
                share = log2(n * n_et[name, w] / (n_t[w] * n_e[name])) / log2(n / n_e[name])
                if share >= pii.GENERALISE:
                    out[d][a, b] = max(out[d].get((a, b), ""), "remove" if share >= pii.REMOVE else "generalise")
    return out


def test_terms_equal_brute_force_and_text_is_rewritten(spark):
    filler = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "the", "of"]
    docs = []
    for i in range(80):
        words = [r.choice(filler) for _ in range(14)]
        if i % 4 == 0:
            words[5:5] = ["director", "Zorro", "boss@corp.example", "of", "Acme" if i % 8 else "beta"]
        if i % 6 == 0:
            words[2:2] = [f"10.0.0.{i % 12}", "gateway"]
        docs.append((i, " ".join(words)))
    docs += [(None, None), (500, "")]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, key string, terms int")
    rows = pii.find_personal_data(df).collect()
    want = brute_terms(docs)
    assert {x.doc_id: [(a, b, c) for a, b, c in x.terms] for x in rows if x.terms} == {d: sorted((a, b, c) for (a, b), c in v.items()) for d, v in want.items() if v}
    assert any(v for v in want.values())
    out = {x.doc_id: x.sanitised for x in pii.sanitise(df).collect()}
    assert len(out) == len(docs) and out[None] == "" and all("@" not in x and "Zorro" not in x for x in out.values())
    assert out[4].count("[EMAIL]") == 1


def test_query_columns(spark, tmp_path):
    spark.createDataFrame([(1, "mail a@b.co or +1 (386) 555-3733", "en"), (1, "mail a@b.co or +1 (386) 555-3733", "en"), (None, None, None)], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = pii.op4_pii(spark, str(tmp_path)).collect()
    assert len(rows) == 3
    one = next(x for x in rows if x.doc_id == 1)
    spans = "email:5:11,phone:15:32"
    assert (one.n_email, one.n_ip, one.n_card, one.n_phone, one.spans, one.base_sha256) == (1, 0, 0, 1, spans, hashlib.sha256(spans.encode()).hexdigest())
    none = next(x for x in rows if x.doc_id is None)
    assert none.spans == "" and none.base_sha256 == hashlib.sha256(b"").hexdigest()


def test_entities_count_in_rows_without_words(spark):
    docs = [(0, "gateway 10.1.1.1 rack"), (1, "gateway 10.1.1.1 rack"), *((i, f"{i} 10.1.1.1 {i}") for i in range(2, 40)), *((i, "gateway rack" if i < 42 else "other words") for i in range(40, 60)), (60, "nothing")]
    rows = pii.find_personal_data(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    want = brute_terms(docs)
    assert {x.doc_id: [(a, b, c) for a, b, c in x.terms] for x in rows if x.terms} == {d: sorted((a, b, c) for (a, b), c in v.items()) for d, v in want.items() if v}
    assert not any(x.terms for x in rows)


def test_terms_far_from_the_entity_count_and_go(spark):
    far = "Zorro " + "of the " * 40 + "mail boss@corp.example " + "of the " * 40 + "zorro"
    docs = [(0, far), (1, far + "."), (2, far), *((i, f"of the mail {i}") for i in range(3, 60))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = {x.doc_id: x.terms for x in pii.find_personal_data(df).collect()}
    assert all([(s, e, a) for s, e, a in rows[i]] == [(0, 5, "remove"), (len(far) - 5, len(far), "remove")] for i in range(3))
    assert not any(rows[i] for i in range(3, 60))


def test_repeated_rows_change_no_term(spark):
    rows = [(0, "Zorro boss@corp.example in the office"), (1, "Zorro boss@corp.example of the team"), *((i, f"the office of team {i} in town") for i in range(2, 20))]
    once = spark.createDataFrame(rows, "doc_id long, text string")
    often = spark.createDataFrame(rows + rows[:2] * 4 + rows[5:6] * 9, "doc_id long, text string")
    got = [{x.doc_id: [tuple(t) for t in x.terms] for x in pii.find_personal_data(df).collect()} for df in (once, often)]
    assert got[0] == got[1] and got[0][0] == [(0, 5, "remove")]


def test_letters_that_change_length_and_the_query_sanitises(spark, tmp_path):
    rows = [(i, f"İstanbulİ {'x' * i} boss@corp.example") for i in range(2)] + [(i, f"the office {i}") for i in range(2, 30)]
    df = spark.createDataFrame([(*d, "c") for d in rows + rows[:1]], "doc_id long, text string, cuts string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    out = pii.op4_pii(spark, str(tmp_path)).collect()
    assert len(out) == 31 and {x.doc_id: x.n_term for x in out}[0] == 1
    want = {x.doc_id: hashlib.sha256(x.sanitised.encode()).hexdigest() for x in pii.sanitise(df).collect()}
    assert all(x.sanitised_sha256 == want[x.doc_id] for x in out)
    assert {x.sanitised for x in pii.sanitise(df).where("doc_id = 0").collect()} == {"  [EMAIL]"}
    df.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert pii.op4_pii(spark, f"{tmp_path}/none").count() == 0


def test_places_are_made_in_one_search_and_right_for_lists_of_any_length(spark):
    counts = [0, 1, 2, 3, 4, 5, 7, 8, 9, 63, 64, 65, 511, 512, 513, 1024, 1025, 5000]
    docs = [(n, "😀 é " + "İab, word 😀" * n + " 9") for n in counts] + [(-1, ""), (-2, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    out = df.select("doc_id", pii.located(df.text, r"\p{L}{3,}+").alias("at"))
    for row in out.collect():
        text = dict(docs)[row.doc_id] or ""
        assert [tuple(x) for x in row["at"]] == [(m.start(), m.end(), m[0]) for m in re.finditer(r"[^\W\d_]{3,}", text)]
    # one search in all: in a lambda over parts of the list, it would be made again for each part
    plan = out._jdf.queryExecution().analyzed().toString()
    assert plan.count("regexp_extract_all(") == 1
