"""A page corpus built from the relational test tables, in Spark and, for checks, in SQL.

A customer is a pair of editions, an order a page, a line item a line: numbered headings from
parts, dosing lines from return flags. Page 0 of the text edition is a table of contents, some of
whose entries name a wrong page. The illustrated edition has changed units, wider blanks, left-out
pages and repeated headings on fixed residues of the order key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import patterns
from ..operators import pages as page_ops
from ..sources.tables import dealt, spread, task_number

TABLES = ("orders", "lineitem", "part", "customer", "region", "nation", "documents")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """key, pg, ord and all: the lines of each order of the text edition, in order, with head."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size")
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag")
    n = max(task_number(items), task_number(orders))
    orders = spread(orders, "o_custkey").withColumn("pg", F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")).cast("long"))
    if task_number(part) > 1:  # too large to be sent to all tasks
        part, items = dealt(part, n, "p_partkey"), dealt(items, n, "l_partkey")
    items = items.join(part, items.l_partkey == part.p_partkey)
    orders, items = dealt(orders, n, "o_orderkey"), dealt(items, n, "l_orderkey")
    rows = items.join(orders, items.l_orderkey == orders.o_orderkey)
    size = F.col("p_size")
    head = F.col("l_linenumber") == 1
    line = (
        F.when(head, F.concat(size % 7 + 1, F.lit("."), size, F.lit(" "), F.upper("p_type")))
        .when(F.col("l_returnflag") == "R", F.concat(F.lit("Give "), F.col("l_quantity").cast("long"), F.lit(" mg/5 mL IM 8 hourly for 5 days")))
        .when(F.col("l_returnflag") == "A", F.concat(F.lit("Weight "), size, F.lit("-"), size + 9, F.lit(" kg oral")))
        .otherwise(F.col("p_name"))
    )
    each = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", line.alias("line"), head.alias("head"))
    rows = rows.groupBy("o_custkey", "pg", "o_orderkey").agg(F.sort_array(F.collect_list(each)).alias("all"))
    lines = F.transform("all", lambda x: F.struct(x["line"].alias("line"), x["head"].alias("head")))
    return rows.select(F.col("o_custkey").alias("key"), "pg", F.col("o_orderkey").alias("ord"), lines.alias("all"))


def corpus(spark: SparkSession, sf_dir: str, edition: str = "text", toc: bool = True) -> DataFrame:
    """cadre, source_id, physical_page and layout_text of an edition's pages."""
    rows = _orders(spark, sf_dir)
    line = lambda x: x["line"]
    heads = F.transform(F.filter("all", lambda x: x["head"]), line)
    label = F.when(F.col("ord") % 5 != 0, F.concat(F.lit("\nPAGE "), F.col("pg") + 10)).otherwise("")
    if edition == "illustrated":
        rows = rows.where("ord % 7 <> 3")
        changed = lambda x: F.when(F.col("ord") % 7 == 1, F.replace(x, F.lit(" mg"), F.lit(" g"))).when(F.col("ord") % 7 == 2, F.replace(x, F.lit(" "), F.lit("  "))).otherwise(x)
        again = F.when((F.col("ord") % 7 == 4) & (F.size(heads) > 0), F.concat(F.lit("\n"), F.get(heads, F.lit(0)))).otherwise("")
        rows = rows.select("key", "pg", F.concat(changed(F.array_join(F.transform("all", line), "\n")), label, again).alias("layout_text"))
    else:
        entry = lambda x: F.concat(x, F.lit(" "), F.col("pg") + 10 + F.when(F.col("ord") % 11 == 0, 1).otherwise(0))
        rows = rows.select("key", "pg", F.concat(F.array_join(F.transform("all", line), "\n"), label).alias("layout_text"), F.transform(heads, entry).alias("entries"))
        if toc:
            # contents come from the customer's pages, which pass once
            page = F.struct("pg", "layout_text", "entries")
            rows = spread(rows, "key").groupBy("key").agg(F.sort_array(F.collect_list(page)).alias("pages"))
            listed = F.flatten(F.transform("pages", lambda p: p["entries"]))
            contents = F.struct(F.lit(0).cast("long").alias("pg"), F.concat(F.lit("TABLE OF CONTENTS\n"), F.array_join(listed, "\n")).alias("layout_text"))
            bodies = F.transform("pages", lambda p: F.struct(p["pg"].alias("pg"), p["layout_text"].alias("layout_text")))
            rows = rows.select("key", F.inline(F.when(F.size(listed) > 0, F.concat(F.array(contents), bodies)).otherwise(bodies)))
    return rows.select(F.concat(F.lit("cust-"), "key").alias("cadre"), F.concat(F.lit("cust-"), "key", F.lit(f"-{edition}")).alias("source_id"), F.col("pg").alias("physical_page"), "layout_text")


def page_records(spark: SparkSession, sf_dir: str, edition: str = "text") -> DataFrame:
    return page_ops.describe_pages(corpus(spark, sf_dir, edition), ("cadre",))


def reviews(candidates: DataFrame) -> DataFrame:
    """Review records for candidates, by residues of the customer's number: approved, stale,
    conflicting, invalid, or none."""
    k = F.regexp_extract("source_id", r"cust-(\d+)-text", 1).cast("long") % 5
    rows = candidates.select("candidate_id", "content_hash", "source_id", k.alias("k")).where("k < 4")
    rows = rows.withColumn("decision", F.explode(F.when(F.col("k") == 2, F.array(F.lit("approved"), F.lit("rejected"))).otherwise(F.array(F.lit("approved")))))
    other = F.regexp_replace("source_id", "-text$", "-illustrated")
    return rows.select(
        F.lit(1).cast("long").alias("schema_version"), "candidate_id", F.when(F.col("k") == 1, F.reverse("content_hash")).otherwise(F.col("content_hash")).alias("content_hash"),
        F.col("source_id").alias("text_source_id"), F.when(F.col("k") == 3, F.lit("nobody")).otherwise(other).alias("illustrated_source_id"),
        F.lit("reviewer").alias("reviewer"), F.lit("2026-01-02").alias("reviewed_at"), "decision", F.lit("checked").alias("notes"),
    )


# The same corpus and the operators over it, in SQL. Each entry is a common table expression that
# may use those before it.
LABEL = r"nullif(regexp_extract(layout_text, '(?i)\bPAGE\s+([0-9]+)\b', 1), '')"
SIGNAL_SQL = {name: pattern.replace("(?iUd)", "(?i)") for name, pattern in patterns.SIGNALS.items()}
SQL_PARTS = {
    "o": "SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS pg FROM orders",
    "l": """SELECT o_custkey AS key, pg, o_orderkey AS ord,
        row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS n,
        l_linenumber = 1 AS head,
        CASE WHEN l_linenumber = 1 THEN (p_size % 7 + 1) || '.' || p_size || ' ' || upper(p_type)
          WHEN l_returnflag = 'R' THEN 'Give ' || l_quantity::BIGINT || ' mg/5 mL IM 8 hourly for 5 days'
          WHEN l_returnflag = 'A' THEN 'Weight ' || p_size || '-' || (p_size + 9) || ' kg oral'
          ELSE p_name END AS line
      FROM lineitem JOIN o ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "pages": """SELECT 'cust-' || key AS cadre, 'cust-' || key || '-text' AS source_id, pg AS physical_page,
        string_agg(line, chr(10) ORDER BY n) || CASE WHEN ord % 5 <> 0 THEN chr(10) || 'PAGE ' || (pg + 10) ELSE '' END AS layout_text
      FROM l GROUP BY key, pg, ord
      UNION ALL
      SELECT 'cust-' || key, 'cust-' || key || '-text', 0,
        'TABLE OF CONTENTS' || chr(10) || string_agg(line || ' ' || (pg + 10 + CASE WHEN ord % 11 = 0 THEN 1 ELSE 0 END), chr(10) ORDER BY pg, n)
      FROM l WHERE head GROUP BY key""",
    "il": """SELECT key, pg, ord, n, head, CASE WHEN ord % 7 = 1 THEN replace(line, ' mg', ' g') WHEN ord % 7 = 2 THEN replace(line, ' ', '  ') ELSE line END AS line
      FROM l WHERE ord % 7 <> 3""",
    "ipages": """SELECT 'cust-' || key AS cadre, 'cust-' || key || '-illustrated' AS source_id, pg AS physical_page,
        string_agg(line, chr(10) ORDER BY n) || CASE WHEN ord % 5 <> 0 THEN chr(10) || 'PAGE ' || (pg + 10) ELSE '' END
          || CASE WHEN ord % 7 = 4 AND bool_or(head) THEN chr(10) || arg_min(line, n) FILTER (head) ELSE '' END AS layout_text
      FROM il GROUP BY key, pg, ord""",
    "allpages": f"""SELECT 'text' AS ed, *, {LABEL} AS label FROM pages UNION ALL SELECT 'illustrated', *, {LABEL} FROM ipages""",
    "ln": """SELECT ed, cadre, source_id, physical_page, label, layout_text LIKE '%TABLE OF CONTENTS%' AS toc,
        unnest(string_split(layout_text, chr(10))) AS line, generate_subscripts(string_split(layout_text, chr(10)), 1) - 1 AS line_index
      FROM allpages""",
    "heads": r"""SELECT ed, cadre, source_id, physical_page, label, line_index, number AS section_number, title, title AS normalized_title, 'numbered' AS level
      FROM (SELECT *, regexp_extract(line, '^\s*(\d+(?:\.\d+){0,3})\.?\s+(.+?)\s*$', 1) AS number,
              regexp_extract(line, '^\s*(\d+(?:\.\d+){0,3})\.?\s+(.+?)\s*$', 2) AS title FROM ln WHERE NOT toc)
      WHERE number <> '' AND (number LIKE '%.%' OR title = upper(title))""",
    "tocs": r"""SELECT cadre, source_id, physical_page, line_index, regexp_extract(line, 'P', 1) AS section_number, trim(regexp_extract(line, 'P', 2)) AS title, regexp_extract(line, 'P', 3) AS printed_page_label
      FROM ln WHERE toc AND regexp_matches(line, 'P')""".replace("'P'", r"'^\s*(\d+(?:\.\d+){0,3})\.?\s+(.+?)\s+(\d+)\s*$'"),
    "sig": " UNION ALL ".join(
        f"SELECT ed, cadre, source_id, physical_page, line_index, {rank} AS rank, '{name}' AS category, unnest(regexp_extract_all(line, '{pattern}', 0)) AS exact_text, "
        f"generate_subscripts(regexp_extract_all(line, '{pattern}', 0), 1) AS nth FROM ln"
        for rank, (name, pattern) in enumerate(SIGNAL_SQL.items())
    ),
    "dose": """SELECT ed, cadre, source_id, physical_page, count(*) AS n_signals, count(*) FILTER (category = 'strength') AS n_strength,
        string_agg(category || ':' || exact_text || ':' || line_index, '|' ORDER BY line_index, rank, nth) AS signals
      FROM sig GROUP BY ALL HAVING count(*) FILTER (category = 'strength') > 0 OR count(*) >= 2""",
    "isl": "SELECT *, physical_page - row_number() OVER (PARTITION BY source_id ORDER BY physical_page) AS island FROM dose",
    "runs": """SELECT isl.ed, isl.cadre, isl.source_id, island, min(isl.physical_page) AS first_page, string_agg(isl.physical_page::VARCHAR, ',' ORDER BY isl.physical_page) AS pages,
        string_agg(label, ',' ORDER BY isl.physical_page) AS labels, string_agg(layout_text, chr(10) || chr(12) || chr(10) ORDER BY isl.physical_page) AS exact_text,
        sum(n_signals) AS n_signals
      FROM isl JOIN allpages p ON isl.source_id = p.source_id AND isl.physical_page = p.physical_page GROUP BY ALL""",
    "lasthead": """SELECT source_id, first_page, arg_max(section_number, (physical_page, line_index)) AS heading_section
      FROM runs JOIN heads USING (source_id) WHERE physical_page <= first_page GROUP BY ALL""",
    "cand": """SELECT runs.*, heading_section, sha256(exact_text) AS content_hash,
        'dose-' || runs.source_id || '-' || runs.first_page || '-' || substr(sha256(exact_text), 1, 16) AS candidate_id
      FROM runs LEFT JOIN lasthead ON runs.source_id = lasthead.source_id AND runs.first_page = lasthead.first_page""",
    "norm": r"""SELECT *, upper(trim(regexp_replace(regexp_replace(exact_text, '-\s*\n\s*', '', 'g'), '\s+', ' ', 'g'))) AS normal FROM cand""",
    "tok": r"""SELECT candidate_id, t, pos, lead(t) OVER (PARTITION BY candidate_id ORDER BY pos) AS after
      FROM (SELECT candidate_id, unnest(regexp_extract_all(normal, '[A-Z]+|\d+(?:\.\d+)?|[%/]', 0)) AS t,
              generate_subscripts(regexp_extract_all(normal, '[A-Z]+|\d+(?:\.\d+)?|[%/]', 0), 1) - 1 AS pos FROM norm)""",
    "prot": r"""SELECT candidate_id, string_agg(t, ' ' ORDER BY pos) AS tokens, string_agg(t || '@' || pos, ' ' ORDER BY pos) AS placed FROM tok
      WHERE regexp_matches(t, '^[0-9]') OR t IN (PROTECTED)
        OR (regexp_matches(t, '^[A-Z]+$') AND regexp_matches(coalesce(after, ''), '^[0-9]'))
      GROUP BY candidate_id""".replace("PROTECTED", ", ".join(f"'{t}'" for t in patterns.PROTECTED)),
    "sides": "SELECT norm.*, coalesce(tokens, '') AS tokens FROM norm LEFT JOIN prot ON norm.candidate_id = prot.candidate_id",
    "cmp": """SELECT t.cadre, t.candidate_id AS text_candidate_id, CASE WHEN i.n = 1 THEN i.id END AS illustrated_candidate_id,
        CASE WHEN i.n IS NULL THEN 'missing_in_illustrated' WHEN i.n > 1 THEN 'ambiguous_alignment' WHEN t.tokens <> i.tokens THEN 'content_mismatch'
          WHEN t.normal = i.normal THEN 'match' ELSE 'format_only_difference' END AS status
      FROM (SELECT * FROM sides WHERE ed = 'text') t
      LEFT JOIN (SELECT cadre, heading_section, count(*) AS n, min(candidate_id) AS id, any_value(tokens) AS tokens, any_value(normal) AS normal FROM sides WHERE ed = 'illustrated' GROUP BY ALL) i
        ON t.cadre = i.cadre AND t.heading_section IS NOT DISTINCT FROM i.heading_section""",
    "rev": """SELECT candidate_id, CASE k WHEN 0 THEN 'approved' WHEN 1 THEN 'stale' WHEN 4 THEN 'pending_clinical_review' ELSE 'conflict' END AS status, cadre
      FROM (SELECT candidate_id, cadre, TRY_CAST(regexp_extract(source_id, 'cust-(\\d+)-text', 1) AS BIGINT) % 5 AS k FROM cand WHERE ed = 'text')""".replace("\\\\", "\\"),
    "hier": """SELECT source_id, cadre, ed, physical_page, line_index, section_number FROM (
        SELECT *, lag(parts) OVER (PARTITION BY source_id ORDER BY physical_page, line_index) AS before
        FROM (SELECT *, list_transform(string_split(section_number, '.'), lambda x: x::BIGINT) AS parts FROM heads)) WHERE parts < before""",
    "refs": """SELECT t.*, CASE WHEN h.n IS NULL THEN 'missing_heading' WHEN h.n > 1 THEN 'duplicate_heading'
          WHEN h.label IS DISTINCT FROM t.printed_page_label THEN 'page_reference_mismatch' END AS code, h.label AS found_label
      FROM tocs t LEFT JOIN (SELECT source_id, section_number, count(*) AS n, any_value(label) AS label FROM heads GROUP BY ALL) h
        ON t.source_id = h.source_id AND t.section_number = h.section_number""",
    "ali": """SELECT t.cadre, t.source_id, t.physical_page, t.line_index, t.section_number AS text_section, coalesce(i.n, 0) AS n_illustrated,
        CASE WHEN i.n IS NULL THEN 'missing' WHEN i.n = 1 THEN 'matched' ELSE 'ambiguous' END AS status
      FROM (SELECT *, trim(regexp_replace(title, '\\s+', ' ', 'g')) AS same FROM heads WHERE ed = 'text') t
      LEFT JOIN (SELECT cadre, section_number, trim(regexp_replace(title, '\\s+', ' ', 'g')) AS same, count(*) AS n FROM heads WHERE ed = 'illustrated' GROUP BY ALL) i
        ON t.cadre = i.cadre AND t.section_number = i.section_number AND t.same = i.same""".replace("\\\\", "\\"),
    "uncov": """SELECT d.cadre, d.source_id, d.physical_page FROM dose d WHERE d.ed = 'text' AND NOT EXISTS (
        SELECT 1 FROM (SELECT cadre, unnest(string_split(pages, ','))::BIGINT AS page FROM cand WHERE ed = 'illustrated') c
        WHERE c.cadre = d.cadre AND c.page = d.physical_page)
      AND NOT EXISTS (SELECT 1 FROM allpages p WHERE p.ed = 'text' AND p.label IS NULL AND p.cadre = d.cadre AND p.physical_page = d.physical_page)""",
    "iss": """SELECT cadre, 'hierarchy_regression' AS code, section_number || ' appears after a later numbered heading' AS message FROM hier
      UNION ALL SELECT cadre, CASE status WHEN 'stale' THEN 'stale_clinical_review' ELSE 'conflicting_clinical_review' END,
        'clinical review for ' || candidate_id || ' is not valid for the current exact content' FROM rev WHERE status IN ('stale', 'conflict')
      UNION ALL SELECT cadre, 'dose_' || replace(CASE status WHEN 'ambiguous_alignment' THEN 'ambiguousalignment' WHEN 'content_mismatch' THEN 'contentmismatch' ELSE 'missinginillustrated' END, '_', ''),
        text_candidate_id || ' has comparison status ' || CASE status WHEN 'ambiguous_alignment' THEN 'AmbiguousAlignment' WHEN 'content_mismatch' THEN 'ContentMismatch' ELSE 'MissingInIllustrated' END
        FROM cmp WHERE status NOT IN ('match', 'format_only_difference')
      UNION ALL SELECT cadre, code, CASE code WHEN 'missing_heading' THEN section_number || ' is referenced by the TOC but missing'
          WHEN 'duplicate_heading' THEN section_number || ' resolves to multiple headings'
          ELSE section_number || ' points to ' || printed_page_label || ', heading is on ' || coalesce('Some("' || found_label || '")', 'None') END FROM refs WHERE code IS NOT NULL""",
    "rep": """SELECT c.cadre, coalesce(a.n, 0) AS heading_alignments, coalesce(s.n, 0) AS heading_issues, coalesce(d.n, 0) AS dose_like_pages, coalesce(k.pages, 0)::BIGINT AS dose_pages_accounted,
        greatest(0, coalesce(d.n, 0) - coalesce(k.pages, 0))::BIGINT AS dose_pages_unaccounted, coalesce(k.n, 0) AS dose_candidates, coalesce(m.n, 0) AS content_mismatches,
        coalesce(r.approved, 0) AS approved_dose_candidates, coalesce(r.pending, 0) AS pending_clinical_review, coalesce(s.blocking, 0) AS n_issues
      FROM (SELECT cadre FROM heads WHERE ed = 'text' UNION SELECT cadre FROM dose WHERE ed = 'text' UNION SELECT cadre FROM iss) c
      LEFT JOIN (SELECT cadre, count(*) AS n FROM ali GROUP BY 1) a ON a.cadre = c.cadre
      LEFT JOIN (SELECT cadre, count(*) FILTER (regexp_matches(code, 'heading|hierarchy|reference')) AS n, count(*) AS blocking FROM iss GROUP BY 1) s ON s.cadre = c.cadre
      LEFT JOIN (SELECT cadre, count(*) AS n FROM dose WHERE ed = 'text' GROUP BY 1) d ON d.cadre = c.cadre
      LEFT JOIN (SELECT cadre, count(*) AS n, sum(len(string_split(pages, ','))) AS pages FROM cand WHERE ed = 'text' GROUP BY 1) k ON k.cadre = c.cadre
      LEFT JOIN (SELECT cadre, count(*) AS n FROM cmp WHERE status = 'content_mismatch' GROUP BY 1) m ON m.cadre = c.cadre
      LEFT JOIN (SELECT cadre, count(*) FILTER (status = 'approved') AS approved, count(*) FILTER (status = 'pending_clinical_review') AS pending FROM rev GROUP BY 1) r ON r.cadre = c.cadre""",
}


def sql(query: str) -> str:
    """query over the parts above, with those it needs."""
    import re

    names, need = list(SQL_PARTS), set()
    todo = [query]
    while todo:
        text = todo.pop()
        for n in names:
            if n not in need and re.search(rf"\b(?:FROM|JOIN|,)\s*\(?{n}\b", text):
                need.add(n)
                todo.append(SQL_PARTS[n])
    return "WITH " + ",\n".join(f"{n} AS ({SQL_PARTS[n]})" for n in names if n in need) + "\n" + query
