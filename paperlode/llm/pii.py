"""Personal data and what gives it away, in DataFrame operations only.

Base spans are e-mail addresses, IP addresses, card and phone numbers. Every different value is a
protected entity. The words of a row that holds an entity, however far from it, are its context
terms; over the whole corpus it is counted in how many rows a term, an entity and both occur. By information theory an entity e of n(e) in N
rows has the information IC(e) = log2(N / n(e)), and a term t discloses
PMI(t, e) = log2(N n(t, e) / (n(t) n(e))) of it. Terms met with the entity in at least SUPPORT
rows that disclose GENERALISE of its information are generalised, those that disclose REMOVE of it
are removed, wherever they stand in a row with that entity.

Offsets count code points from 0, ends are exclusive. Results for odd input: a null text counts as
empty; rows of equal doc_id and text get equal results; spans of different kinds may overlap;
terms never overlap base spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name, saved, table

KINDS = ["email", "ip", "card", "phone"]
#: Java patterns of the base kinds. A match can only begin where a run of its first characters
#: begins, or where the last match ended (\G); loops that cannot give back are possessive. So
#: they find what the plain forms find, in linear time and without deep recursion.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A cheap test that a text may hold the kind at all.
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
TERM = r"\p{L}{3,}+"
SUPPORT, GENERALISE, REMOVE = 2, 0.5, 0.8
#: Bits of the map of rows that may be repeated (8 MB).
FILTER_BITS = 1 << 26
#: How far from an entity its terms may stand: as far as any text goes.
WINDOW = 2**31 - 1


def located(text: Column, pattern: str) -> Column:
    """array of (s, e, m): start, end and string of the pattern's matches in text. Ends are running
    sums of the lengths of gaps and matches, made in as many passes as their number has binary digits."""

    def places(found: Column) -> Column:
        n = F.size(found)
        steps = F.slice(F.zip_with(F.split(text, pattern, -1), found, lambda gap, m: F.length(gap) + F.length(m)), F.lit(1), n)
        # pass k adds to each sum the one that stands 2**k before it
        add = lambda v, k: F.slice(F.zip_with(v, F.concat(F.array_repeat(F.lit(0), F.pow(F.lit(2), k).cast("int")), v), lambda x, y: x + y), F.lit(1), n)
        ends = F.aggregate(F.sequence(F.lit(0), F.length(F.bin(n)) - 1), steps, add)
        return F.when(n > 0, F.zip_with(ends, found, lambda e, m: F.struct((e - F.length(m)).alias("s"), e.alias("e"), m.alias("m")))).otherwise(none)

    none = F.array().cast("array<struct<s:int,e:int,m:string>>")
    # an expression in a lambda is worked out each time it stands there: so matches are bound to a name first
    return F.transform(F.array(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))), places)[0]


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _is_luhn(digits: Column) -> Column:
    back = F.reverse(digits)
    n = F.length(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return acc + d - F.when(d > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _is_valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        small = lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255"))
        return F.forall(F.split(m, r"\."), lambda p: small(F.regexp_replace(p, "^0+", "")))
    if kind == "card":
        d = _digits(m)
        return F.when(F.length(d).between(16, 19), _is_luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(m)).between(8, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """Valid leftmost non-overlapping matches of one kind, as (s, e, m)."""
    none = F.array().cast("array<struct<s:int,e:int,m:string>>")
    may = F.contains(text, F.lit(NEEDS[kind])) if NEEDS[kind] else text.rlike("[0-9]{2}|[0-9][ -][0-9]")
    return F.when(may, F.filter(located(text, PATTERNS[kind]), lambda x: _is_valid(kind, x["m"]))).otherwise(none)


def _words(text: Column, spans: Column) -> Column:
    """array of (term, s, e): the words of text, those that overlap a base span left out."""
    words = F.transform(located(text, TERM), lambda w: F.struct(F.lower(w["m"]).alias("term"), w["s"].alias("s"), w["e"].alias("e")))
    return F.filter(words, lambda w: ~F.exists(spans, lambda b: (w["s"] < b["e"]) & (w["e"] > b["s"])))


def _key(id_col: str, text: Column) -> Column:
    return F.unhex(F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.lit("\n"), text).cast("binary")))


def located_data(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, key, the base spans of each kind, and words; one row for each of docs. Rows without a
    base span have no words, as none of theirs can be a context term."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), _key(id_col, text).alias("key"), text.alias("text"))
    rows = rows.select("id", "key", "text", *(base_spans(F.col("text"), k).alias(k) for k in KINDS))
    rows = rows.withColumn("all_spans", F.concat(*map(_tag, KINDS)))
    none = F.array().cast("array<struct<term:string,s:int,e:int>>")
    words = F.when(F.size("all_spans") > 0, _words(F.col("text"), F.col("all_spans"))).otherwise(none)
    return rows.select("id", "key", *KINDS, words.alias("words"))


def _tag(kind: str) -> Column:
    return F.transform(F.col(kind), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.concat(F.lit(f"{kind}:"), x["m"]).alias("entity")))


def _held(found: DataFrame) -> DataFrame:
    """entity and key of the rows of found that hold it."""
    names = F.flatten(F.array(*(F.transform(_tag(k), lambda x: x["entity"]) for k in KINDS)))
    return found.select(F.explode(F.array_distinct(names)).alias("entity"), "key").distinct()


def term_counts(found: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """hash and n_term (rows that hold the term) over the whole corpus, and the number of rows; a row
    that is repeated counts once, as it does for entities.

    All rows are counted, partial counts go over the network, and what repeated rows have too much
    is taken off. Which rows may be repeated is told by a bitmap of FILTER_BITS, the only thing that
    is broadcast; where it is full, all rows are grouped by their keys, which is as right.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), lambda w: F.xxhash64(F.lower(w))))
    at = F.pmod(F.xxhash64("key"), F.lit(FILTER_BITS))
    page, bit = F.shiftright(at, 15), at.bitwiseAND(F.lit(32767)).cast("int")
    again = found.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    pages = saved(again.groupBy(page.alias("page")).agg(F.bitmap_construct_agg(bit).alias("bits")), "pages")
    keyed = docs.select(_key(id_col, text).alias("key"), text.alias(text_col)).withColumn("page", page).join(F.broadcast(pages), "page")
    byte = F.conv(F.hex(F.substring("bits", F.shiftright(bit, 3) + 1, F.lit(1))), 16, 10).cast("int")
    keyed = keyed.where(byte.bitwiseAND(F.pow(F.lit(2), bit.bitwiseAND(F.lit(7))).cast("int")) > 0)
    more = saved(keyed.groupBy("key").agg(F.count("*").alias("n"), F.first(words).alias("hashes")).where("n > 1").select(F.col("n") - 1, "hashes").toDF("more", "hashes"), "again")
    once = docs.select(F.explode(words).alias("hash"), F.lit(1).cast("long").alias("n"))
    counts = once.union(more.select(F.explode("hashes").alias("hash"), -F.col("more"))).groupBy("hash").agg(F.sum("n").alias("n_term"))
    return counts, docs.count() - (more.agg(F.sum("more")).first()[0] or 0)


def disclosing_terms(found: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """entity, term, disclosed (share of the entity's information) and action; found has every row
    of docs, as an entity counts where it has no context too."""
    held = _held(found)
    # an entity in fewer rows than SUPPORT meets no term in that many
    entities = held.groupBy("entity").agg(F.count("*").alias("n_entity")).where(F.col("n_entity") >= SUPPORT)
    words = found.where(F.size("words") > 0).dropDuplicates(["key"]).select("key", F.array_distinct(F.transform("words", lambda w: w["term"])).alias("terms"))
    pairs = held.join(entities, "entity", "left_semi").join(words, "key").select("entity", F.explode("terms").alias("term"))
    met = pairs.groupBy("entity", "term").agg(F.count("*").alias("n_both")).where(F.col("n_both") >= SUPPORT)
    terms, n_rows = term_counts(found, docs, id_col, text_col)
    n, log = F.lit(float(n_rows)), F.log2
    rows = met.join(entities, "entity").withColumn("hash", F.xxhash64("term")).join(terms, "hash")
    pmi = log(n) + log("n_both") - log("n_term") - log("n_entity")
    ic = log(n) - log("n_entity")
    rows = rows.withColumn("disclosed", F.when(ic > 0, pmi / ic).otherwise(0.0)).where(F.col("disclosed") >= GENERALISE)
    return rows.select("entity", "term", "disclosed", F.when(F.col("disclosed") >= REMOVE, "remove").otherwise("generalise").alias("action"))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, key, base spans of each kind as (s, e, m), and terms as (s, e, action), for each row."""
    found = saved(located_data(docs, id_col, text_col), "personal")
    terms = saved(disclosing_terms(found, docs, id_col, text_col), "terms")
    words = found.where(F.size("words") > 0).select("key", F.explode("words").alias("w")).select("key", "w.*")
    words = words.join(terms.select("term").distinct(), "term", "left_semi").distinct()
    # an entity may have many terms: only those that stand in a row are paired with its entities
    marked = _held(found).join(terms.select("entity").distinct(), "entity", "left_semi").join(words, "key")
    hits = marked.join(terms, ["entity", "term"]).groupBy("key", "s", "e").agg(F.max("action").alias("action"))
    per_row = hits.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("s", "e", "action"))).alias("terms"))
    none = F.array().cast("array<struct<s:int,e:int,action:string>>")
    out = found.join(per_row, "key", "left")
    return out.select(F.col("id").alias(id_col), "key", *KINDS, F.coalesce("terms", none).alias("terms"))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", column: str = "sanitised") -> DataFrame:
    """docs with the text in which base spans and generalised terms are replaced by their kind in
    brackets and removed terms are left out. Null texts give empty ones. A column of that name is
    replaced; all others come along."""
    docs = docs.drop(column)
    key, cuts = free_name(docs.columns, "cut_key"), free_name(docs.columns, "cuts")
    found = find_personal_data(docs, id_col, text_col).dropDuplicates(["key"])
    found = found.select(F.col("key").alias(key), cuts_of().alias(cuts))
    rows = docs.withColumn(key, _key(id_col, F.coalesce(F.col(text_col), F.lit("")))).join(found, key, "left")
    return rows.withColumn(column, without(F.coalesce(F.col(text_col), F.lit("")), F.col(cuts))).drop(key, cuts)


def cuts_of() -> Column:
    """What is to be replaced by what, as sorted (s, e, mark), from the columns of find_personal_data."""
    marks = [_mark(k) for k in KINDS]
    marks.append(F.transform("terms", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.when(x["action"] == "remove", "").otherwise("[TERM]").alias("mark"))))
    return F.array_sort(F.concat(*marks))


def without(text: Column, cuts: Column) -> Column:
    """text with cuts made; of what overlaps, the first mark stands."""

    def step(acc: Column, x: Column) -> Column:
        piece = F.concat(F.substring(text, acc["at"] + 1, F.greatest(F.lit(0), x["s"] - acc["at"])), F.when(x["s"] >= acc["at"], x["mark"]).otherwise(""))
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"), F.concat(acc["out"], piece).alias("out"))

    done = F.aggregate(cuts, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(cuts) > 0, done).otherwise(text)


def _mark(kind: str) -> Column:
    return F.transform(F.col(kind), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(f"[{kind.upper()}]").alias("mark")))


def _joined(kinds: list[str]) -> Column:
    def one(kind: str) -> Column:
        return F.transform(F.col("terms" if kind == "term" else kind), lambda x: F.concat_ws(":", F.lit(kind), x["s"], x["e"]))

    return F.array_join(F.concat(*map(one, kinds)), ",")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of every row, and the SHA-256 of its sanitised text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    text = F.coalesce(F.col("text"), F.lit(""))
    found = find_personal_data(docs).dropDuplicates(["key"]).drop("doc_id")
    rows = docs.select("doc_id", text.alias("text"), _key("doc_id", text).alias("key")).join(found, "key")
    return rows.select(
        "doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS), F.sha2(_joined(KINDS), 256).alias("base_sha256"),
        _joined([*KINDS, "term"]).alias("spans"), F.size("terms").cast("long").alias("n_term"), F.sha2(without(F.col("text"), cuts_of()), 256).alias("sanitised_sha256"),
    )
