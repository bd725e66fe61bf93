"""Text expressions. All but NFKC are built-in functions and stay in generated code."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import patterns

SOFT_HYPHEN, NBSP = "­", " "


def lines(c: Column) -> Column:
    r"""Lines of a text: cut at \n, one \r right before it belongs to the cut, no empty last line."""
    body = F.regexp_replace(F.replace(c, F.lit("\r\n"), F.lit("\n")), r"\n\z", "")
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(body, "\n", -1))


def is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.char_length(c)


def trim(c: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def collapse(c: Column) -> Column:
    """Runs of Unicode white space as one blank, none at the ends."""
    single = F.when(is_ascii(c), F.regexp_replace(c, r"\s\s+|[^ \S]", " ")).otherwise(F.regexp_replace(c, r"(?U)\s+", " "))
    return F.trim(single)


@F.pandas_udf(StringType())
def _nfkc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


def nfkc(c: Column) -> Column:
    """Unicode compatibility composition, the one step without a built-in. ASCII texts are equal to
    their form, so that only the others are sent to Python."""
    other = F.when(~is_ascii(c), c)
    return F.coalesce(_nfkc(other), c)


def normalize_title(c: Column) -> Column:
    return F.upper(collapse(nfkc(c)))


def normalize_layout_text(c: Column) -> Column:
    """Text that two editions share whatever their line breaks, dashes, quotes and blanks.

    Words broken at a line end are joined before dashes are unified, so a range that is broken after
    a hyphen loses it, and one broken after a longer dash doesn't.
    """
    joined = F.regexp_replace(c, r"(?U)-\s*\n\s*", "")
    other = F.translate(F.replace(joined, F.lit(SOFT_HYPHEN), F.lit("")), "–—‘’“”", "--''\"\"")
    return F.upper(collapse(nfkc(F.when(is_ascii(c), F.regexp_replace(c, r"-\s*\n\s*", "")).otherwise(other))))


def protected_tokens(normalized: Column) -> Column:
    """array of (normalized, position): numbers, the word before a number, and the fixed words, of
    a text in normal form; position counts all tokens."""
    of = lambda pattern: F.regexp_extract_all(normalized, F.lit(pattern), F.lit(0))
    tokens = F.when(is_ascii(normalized), of(patterns.TOKEN.replace("(?U)", ""))).otherwise(of(patterns.TOKEN))
    # a copy that is one ahead gives each token its successor without looking anything up
    paired = F.zip_with(F.concat(F.array(F.lit("")), tokens), tokens, lambda x, after: F.struct(x.alias("x"), after.alias("after")))
    placed = F.transform(paired, lambda p, i: F.struct(p["x"].alias("normalized"), (i - 1).cast("long").alias("position"), p["after"].alias("after")))
    # a token's first character tells its kind
    number = lambda x: (x >= "0") & (x < ":")
    word = lambda x: (x >= "A") & (x < "[")
    kept = F.filter(placed, lambda p: number(p["normalized"]) | p["normalized"].isin(patterns.PROTECTED) | (word(p["normalized"]) & F.coalesce(number(p["after"]), F.lit(False))))
    return F.transform(kept, lambda p: F.struct(p["normalized"].alias("normalized"), p["position"].alias("position")))


def protected_words(normalized: Column) -> Column:
    """Texts of protected_tokens; of an ASCII text by one pattern."""
    found = F.regexp_extract_all(normalized, F.lit(patterns.ASCII_PROTECTED), F.lit(0))
    return F.when(is_ascii(normalized), found).otherwise(F.transform(protected_tokens(normalized), lambda t: t["normalized"]))


def number_parts(section: Column) -> Column:
    """Parts of a section number as an array of numbers; parts that are no 32-bit number are left out."""
    parts = F.transform(F.split(section, r"\."), lambda x: x.try_cast("bigint"))
    return F.filter(parts, lambda x: x.isNotNull() & (x <= 4294967295))


def issue(code: str, message: Column) -> Column:
    return F.struct(F.lit(code).alias("code"), F.lit(True).alias("blocking"), message.alias("message"))
