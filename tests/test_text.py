import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from paperlode.functions import patterns, text


def values(spark, rows, *columns):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i long, x string")
    return [tuple(r)[1:] for r in df.select("i", *columns).orderBy("i").collect()]


def test_lines(spark):
    rows = ["a\r\nb\n\nc\n", "", "x\r", "\n", "a\r\r\n", "\n\n", None]
    want = [["a", "b", "", "c"], [], ["x\r"], [""], ["a\r"], ["", ""], None]
    assert [x for (x,) in values(spark, rows, text.lines(F.col("x")))] == want


def test_unicode_blanks(spark):
    rows = ["  a  b ", "a\x85b c", "\t"]
    got = values(spark, rows, text.trim(F.col("x")), text.collapse(F.col("x")))
    assert got == [("a  b", "a b"), ("a\x85b c", "a b c"), ("", "")]


def test_normal_form(spark):
    rows = ["para-\ncetamol  5 mg", "5-\n14 kg", "5–\n14 kg", "so­ft ﬁ “x” it’s —", "straße"]
    want = ["PARACETAMOL 5 MG", "514 KG", "5- 14 KG", "SOFT FI \"X\" IT'S -", "STRASSE"]
    assert [x for (x,) in values(spark, rows, text.normalize_layout_text(F.col("x")))] == want


def plain_tokens(x):
    found = re.findall(r"[A-Z]+|\d+(?:\.\d+)?|[%/]", x)
    keep = set()
    for i, t in enumerate(found):
        if t[0].isascii() and t[0].isdigit():
            keep.add(i)
            if i and found[i - 1].isalpha():
                keep.add(i - 1)
        if t in patterns.PROTECTED:
            keep.add(i)
    return [(found[i], i) for i in sorted(keep)]


def test_protected_tokens(spark):
    r = random.Random(1)
    rows = ["AMOXICILLIN 2.5 ML IM 8 HOURLY FOR 5 DAYS WEIGHT 5-14 KG REFER; DO NOT REPEAT", "", "NOTHING"]
    rows += [" ".join(r.choice(["MG", "5", "2.5", "%", "/", "ABC", "NOT", "X-5", "é"]) for _ in range(r.randint(0, 12))) for _ in range(200)]
    got = [[tuple(t) for t in x] for (x,) in values(spark, rows, text.protected_tokens(F.col("x")))]
    assert got == [plain_tokens(x) for x in rows]
    assert [t for t, _ in got[0]] == "AMOXICILLIN 2.5 ML IM 8 HOURLY FOR 5 DAYS WEIGHT 5 14 KG REFER NOT".split()


@pytest.mark.parametrize("seed", [1, 2])
def test_nfkc_of_any_text(spark, seed):
    r = random.Random(seed)
    rows = ["".join(chr(r.choice([r.randint(32, 126), r.randint(160, 0x2FFF), 0xFB01])) for _ in range(30)) for _ in range(100)] + [None, ""]
    assert [x for (x,) in values(spark, rows, text.nfkc(F.col("x")))] == [None if x is None else unicodedata.normalize("NFKC", x) for x in rows]
