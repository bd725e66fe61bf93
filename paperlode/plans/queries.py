"""One query for each operator, over the synthetic corpus or the document table, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import comparison, doses, headings, pages, report, review
from ..sources import artifacts
from ..sources.bbox import parse_bbox_layout
from ..sources.config import check_files, config_issues, digests
from ..sources.tables import stored
from . import corpus as run
from .synthetic import LABEL, SIGNAL_SQL, corpus, page_records, reviews, sql, table

K = ("cadre",)
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def _pages(spark: SparkSession, d: str, edition: str) -> DataFrame:
    """An edition's pages with their labels, as a table: several operators read them."""
    label = F.nullif(F.regexp_extract("layout_text", pages.patterns.PAGE_LABEL, 1), F.lit(""))
    return stored(corpus(spark, d, edition).withColumn("printed_page_label", label), "pages")


def _side(spark: SparkSession, d: str, edition: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    p = _pages(spark, d, edition)
    return p, headings.extract_headings(p, K), doses.detect_dose_like_pages(p, K, doses.PAGE_TEXT)


def _candidates(spark: SparkSession, d: str, edition: str = "text") -> DataFrame:
    return doses.group_dose_candidates(*_side(spark, d, edition), K)


def _joined(column: str, *fields: str) -> F.Column:
    return F.array_join(F.transform(column, lambda x: F.concat_ws(":", *(x[f] for f in fields))), "|")


def q_page_records(spark, d):
    rows = page_records(spark, d)
    return rows.select("source_id", "physical_page", "printed_page_label", "normalized_content_hash", F.array_join("header_candidates", "|").alias("headers"),
                       F.array_join("footer_candidates", "|").alias("footers"), F.size("warnings").cast("long").alias("n_warnings"))


def q_split_layout(spark, d):
    """Whole documents cut into pages again, each with its bounding page."""
    p = corpus(spark, d, toc=False)
    whole = p.groupBy("cadre", "source_id").agg(F.sort_array(F.collect_list(F.struct("physical_page", "layout_text"))).alias("all"))
    layout = F.concat(F.array_join(F.transform("all", lambda x: x["layout_text"]), "\f"), F.lit("\f"))
    boxes = F.transform("all", lambda x: F.struct(F.lit(595.0).cast("float").alias("width"), F.lit(842.0).cast("float").alias("height"), F.array().cast(f"array<{pages.BLOCK}>").alias("blocks")))
    rows = pages.build_page_records(whole.select("cadre", "source_id", layout.alias("layout_text"), boxes.alias("bounding_pages")), K)
    return rows.select("source_id", "physical_page", "printed_page_label", "normalized_content_hash", F.col("width").cast("double").alias("width"))


def q_lines(spark, d):
    return pages.page_lines(corpus(spark, d), "source_id", "physical_page")


def q_printed_labels(spark, d):
    return page_records(spark, d).groupBy("printed_page_label").agg(F.count("*").alias("n_pages"))


def q_headings(spark, d):
    rows = _side(spark, d, "text")[1]
    return rows.select("source_id", "physical_page", "line_index", "section_number", "exact_title", "normalized_title", "level", "printed_page_label")


def q_toc_references(spark, d):
    return headings.extract_toc_references(corpus(spark, d), K).select("source_id", "section_number", "title", "printed_page_label", "line_index")


def q_hierarchy_regressions(spark, d):
    return headings.validate_heading_hierarchy(_side(spark, d, "text")[1], K).select("source_id", "physical_page", "line_index", "issue.code", "issue.message")


def q_reference_validation(spark, d):
    p, h, _ = _side(spark, d, "text")
    rows = headings.validate_heading_references(h, headings.extract_toc_references(p, K), K)
    return rows.select("source_id", "section_number", "line_index", F.col("issue.code").alias("code"), F.col("issue.message").alias("message"))


def q_dose_signals(spark, d):
    rows = corpus(spark, d).select("source_id", "physical_page", F.explode(doses.signals(F.col("layout_text"))).alias("s"))
    return rows.select("source_id", "physical_page", "s.line_index", "s.category", "s.exact_text")


def q_document_signals(spark, d):
    """Signals of the document table's texts."""
    docs = table(spark, d, "documents")
    rows = docs.select("doc_id", F.explode(doses.signals(F.col("text"))).alias("s"))
    return rows.groupBy("doc_id", "s.category").agg(F.count("*").alias("n"))


def q_dose_like_pages(spark, d):
    return _side(spark, d, "text")[2].select("source_id", "physical_page", F.size("signals").cast("long").alias("n_signals"), _joined("signals", "category", "exact_text", "line_index").alias("signals"))


def q_dose_islands(spark, d):
    rows = doses.dose_islands(_side(spark, d, "text")[2], K)
    return rows.groupBy("source_id", "island").agg(F.count("*").alias("n_pages"), F.min("physical_page").alias("first_page"))


def q_dose_candidates(spark, d):
    rows = _candidates(spark, d)
    return rows.select("candidate_id", "source_id", "heading_section", F.array_join("physical_pages", ",").alias("pages"), F.array_join("printed_page_labels", ",").alias("labels"),
                       "content_hash", F.size("signals").cast("long").alias("n_signals"), "comparison_status", "clinical_review_status")


def q_heading_as_of(spark, d):
    """The heading that holds at each page of the illustrated edition."""
    p, h, _ = _side(spark, d, "illustrated")
    return doses.heading_as_of(p.select("cadre", "source_id", "physical_page"), h, K).select("source_id", "physical_page", "heading_section")


def q_dose_coverage(spark, d):
    """Dose-like pages of the text edition held against the illustrated one's candidates, which lack
    some pages; pages without a printed label are dismissed."""
    p, _, dose = _side(spark, d, "text")
    dismissed = p.where("printed_page_label is null").select("cadre", "physical_page")
    return doses.validate_dose_coverage(dose, _candidates(spark, d, "illustrated"), dismissed, K).select("source_id", "physical_page", "issue.code", "issue.message")


def q_normalize_text(spark, d):
    rows = _candidates(spark, d)
    return rows.select("candidate_id", F.sha2(text.normalize_layout_text(F.col("exact_text")), 256).alias("normal_sha256"))


def q_document_normal_forms(spark, d):
    """Normal form of every document, NFKC among its steps."""
    docs = table(spark, d, "documents")
    return docs.select("doc_id", F.sha2(text.normalize_layout_text(F.coalesce("text", F.lit(""))), 256).alias("normal_sha256"))


def q_exact_copies(spark, d):
    """Document texts that are equal but for white space, by content hash."""
    docs = table(spark, d, "documents").withColumn("hash", F.sha2(text.collapse(F.coalesce("text", F.lit(""))), 256))
    return docs.groupBy("hash").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id")).where("n > 1")


def q_protected_tokens(spark, d):
    rows = _candidates(spark, d).select("candidate_id", text.protected_tokens(text.normalize_layout_text(F.col("exact_text"))).alias("t"))
    return rows.select("candidate_id", F.array_join(F.transform("t", lambda x: F.concat(x["normalized"], F.lit("@"), x["position"])), " ").alias("placed"))


def q_heading_alignment(spark, d):
    rows = comparison.align_headings(_side(spark, d, "text")[1], _side(spark, d, "illustrated")[1], K)
    return rows.select("source_id", "physical_page", "line_index", "text_section", F.size("illustrated_sections").cast("long").alias("n_illustrated"), "status")


def _compared(spark, d):
    return comparison.compare_candidates(_candidates(spark, d), _candidates(spark, d, "illustrated"), K)


def q_candidate_comparison(spark, d):
    return _compared(spark, d).select("text_candidate_id", "illustrated_candidate_id", "status")


def q_comparison_issues(spark, d):
    return comparison.comparison_issues(_compared(spark, d), K).select("text_candidate_id", "issue.code", "issue.message")


def q_apply_reviews(spark, d):
    found = _candidates(spark, d)
    return review.apply_reviews(found, reviews(found), K).select("candidate_id", "status", F.col("issue.code").alias("code"))


def _results(spark, d):
    return run.analyse({s: _pages(spark, d, s) for s in run.SIDES}, reviews, stored)


def q_cadre_report(spark, d):
    rows = _results(spark, d).reports
    return rows.select(*report.REPORT_FIELDS[:-1], F.size("issues").cast("long").alias("n_issues"))


def q_issue_list(spark, d):
    rows = _results(spark, d).issues
    return rows.select("cadre", "issue.code", "issue.message")


def q_candidate_statuses(spark, d):
    """Final statuses of the text edition's candidates, after comparison and reviews."""
    return _results(spark, d).candidates["text"].select("candidate_id", "comparison_status", "clinical_review_status")


def q_blocking_issues(spark, d):
    return report.blocking_issues(_results(spark, d).reports).select(F.col("blocking_issues").cast("long").alias("blocking_issues"))


def q_run_summary(spark, d):
    p, h, _ = _side(spark, d, "text")
    sources = p.select("source_id").distinct().withColumn("sha256", F.sha2("source_id", 256))
    return report.source_summaries(sources, p, h, _candidates(spark, d))


def q_bbox_pages(spark, d):
    """Bounding-box documents made from the corpus and parsed again: pages, lines and words."""
    p = corpus(spark, d, toc=False)
    box = ' xMin="1" yMin="2" xMax="3" yMax="4"'
    word = lambda w: F.concat(F.lit(f"<word{box}>"), w, F.lit("</word>"))
    line = lambda x: F.concat(F.lit(f"<line{box}>"), F.array_join(F.transform(F.split(x, " "), word), ""), F.lit("</line>"))
    page = F.concat(F.lit(f'<page width="595" height="842"><flow><block{box}>'), F.array_join(F.transform(text.lines(F.col("layout_text")), line), ""), F.lit("</block></flow></page>"))
    whole = p.groupBy("source_id").agg(F.sort_array(F.collect_list(F.struct("physical_page", page.alias("page")))).alias("all"))
    xhtml = F.concat(F.lit("<html><body><doc>"), F.array_join(F.transform("all", lambda x: x["page"]), ""), F.lit("</doc></body></html>"))
    found = whole.select("source_id", F.posexplode(parse_bbox_layout(xhtml)).alias("at", "page"))
    lines = F.flatten(F.transform("page.blocks", lambda b: b["lines"]))
    words = F.flatten(F.transform(lines, lambda x: x["words"]))
    return found.select("source_id", (F.col("at") + 1).cast("long").alias("nth"), F.size(lines).cast("long").alias("n_lines"), F.size(words).cast("long").alias("n_words"),
                        F.array_join(F.transform(words, lambda w: w["text"]), " ").alias("words"))


def q_source_verification(spark, d):
    """Files of the test data held against a manifest with one wrong size, one wrong hash and one file
    that is not there."""
    paths = [f"{d}/{n}.parquet" for n in TABLES]
    files = digests(spark, paths)
    expected = files.select("path", (F.col("byte_size") + F.when(F.col("path") == "nation.parquet", 1).otherwise(0)).alias("byte_size"),
                            F.when(F.col("path") == "supplier.parquet", F.upper("sha256")).otherwise(F.col("sha256")).alias("sha256"))
    expected = expected.union(spark.range(1).select(F.lit("lost.parquet"), F.lit(1).cast("long"), F.lit("0" * 64)))
    return check_files(spark, expected, paths).select("path", "status")


def q_config_validation(spark, d):
    """Rules of pairs and manifests over customers: a pair for each, sharing and mixing some paths."""
    k = F.col("c_custkey")
    c = table(spark, d, "customer")
    pairs = c.select(F.concat(F.lit("c"), k % 400).alias("cadre"), F.concat(F.lit("m"), k, F.lit("-text")).alias("text"), F.concat(F.lit("m"), F.when(k % 9 == 0, k + 1).otherwise(k), F.lit("-illustrated")).alias("illustrated"))
    side = F.explode(F.array(F.lit("text"), F.lit("illustrated")))
    manifests = c.where("c_custkey % 13 <> 0").select(k.alias("k"), side.alias("side")).select(
        F.concat(F.lit("m"), "k", F.lit("-"), "side").alias("path"), F.concat(F.lit("c"), F.when(F.col("k") % 17 == 0, 401).otherwise(F.col("k") % 400)).alias("cadre"),
        F.when(F.col("k") % 19 == 0, "text").otherwise(F.col("side")).alias("representation"))
    return config_issues(pairs, manifests)


def q_semantic_digest(spark, d):
    rows = corpus(spark, d).select("source_id", F.concat(F.lit("pages/"), "physical_page").alias("path"), F.col("layout_text").alias("content"))
    return artifacts.digest_of(rows, ["source_id"])


def q_candidate_jsonl(spark, d):
    """Candidates as the lines that the JSON Lines writer puts out."""
    rows = _candidates(spark, d)
    return rows.select("candidate_id", artifacts.json_row("schema_version", "candidate_id", "source_id", "heading_section", "physical_pages", "printed_page_labels", "comparison_status").alias("line"))


def q_cadre_markdown(spark, d):
    return _results(spark, d).reports.select("cadre", report.cadre_markdown().alias("markdown"))


QUERIES = {n[2:]: f for n, f in list(globals().items()) if n.startswith("q_")}

_CAND = "candidate_id, source_id, heading_section, pages, coalesce(labels, '') AS labels, content_hash, n_signals::BIGINT AS n_signals, 'not_compared' AS comparison_status, 'pending_clinical_review' AS clinical_review_status"
_HASH = r"sha256(trim(regexp_replace(layout_text, '\s+', ' ', 'g')))"
ORACLE_SQL = {
    "page_records": sql(rf"""SELECT source_id, physical_page, {LABEL} AS printed_page_label, {_HASH} AS normalized_content_hash,
      array_to_string(string_split(layout_text, chr(10))[1:3], '|') AS headers, array_to_string(list_reverse(string_split(layout_text, chr(10)))[1:3], '|') AS footers,
      CASE WHEN {LABEL} IS NULL THEN 1 ELSE 0 END::BIGINT AS n_warnings FROM pages"""),
    "split_layout": sql(f"""SELECT source_id, row_number() OVER (PARTITION BY source_id ORDER BY physical_page) AS physical_page, {LABEL} AS printed_page_label,
      {_HASH} AS normalized_content_hash, 595.0::DOUBLE AS width FROM pages WHERE physical_page > 0"""),
    "lines": sql("SELECT source_id, physical_page, line_index::BIGINT AS line_index, line FROM ln WHERE ed = 'text'"),
    "printed_labels": sql(f"SELECT {LABEL} AS printed_page_label, count(*) AS n_pages FROM pages GROUP BY 1"),
    "headings": sql("SELECT source_id, physical_page, line_index::BIGINT AS line_index, section_number, title AS exact_title, upper(normalized_title) AS normalized_title, level, label AS printed_page_label FROM heads WHERE ed = 'text'"),
    "toc_references": sql("SELECT source_id, section_number, title, printed_page_label, line_index::BIGINT AS line_index FROM tocs"),
    "hierarchy_regressions": sql("SELECT source_id, physical_page, line_index::BIGINT AS line_index, 'hierarchy_regression' AS code, section_number || ' appears after a later numbered heading' AS message FROM hier WHERE ed = 'text'"),
    "reference_validation": sql("""SELECT source_id, section_number, line_index::BIGINT AS line_index, code, CASE code WHEN 'missing_heading' THEN section_number || ' is referenced by the TOC but missing'
      WHEN 'duplicate_heading' THEN section_number || ' resolves to multiple headings'
      WHEN 'page_reference_mismatch' THEN section_number || ' points to ' || printed_page_label || ', heading is on ' || coalesce('Some("' || found_label || '")', 'None') END AS message FROM refs"""),
    "dose_signals": sql("SELECT source_id, physical_page, line_index::BIGINT AS line_index, category, exact_text FROM sig WHERE ed = 'text'"),
    # characters beyond ASCII become ASCII ones of their kind: its pattern engine knows no others
    "document_signals": "WITH t AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(replace(replace(text, chr(383), 's'), chr(8490), 'k'),"
        r" '[^\x00-\x7F\P{Nd}]', '5', 'g'), '[^\x00-\x7F\P{Z}]|\x{85}', ' ', 'g'), '[^\x00-\x7F\P{L}]|[^\x00-\x7F\P{M}]|[^\x00-\x7F\P{Pc}]|[^\x00-\x7F\P{Nl}]', 'Q', 'g') AS text FROM documents)"
        " SELECT doc_id, category, sum(n)::BIGINT AS n FROM (" + " UNION ALL ".join(
        f"SELECT doc_id, '{name}' AS category, len(regexp_extract_all(line, '{pattern}', 0)) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t)"
        for name, pattern in SIGNAL_SQL.items()
    ) + ") GROUP BY ALL HAVING sum(n) > 0",
    "exact_copies": r"""SELECT hash, count(*) AS n, min(doc_id) AS first_id FROM (
      SELECT doc_id, sha256(trim(regexp_replace(coalesce(text, ''), '[\x09-\x0D\x{85}\p{Z}]+', ' ', 'g'))) AS hash FROM documents) GROUP BY hash HAVING count(*) > 1""",
    "source_verification": "SELECT path, CASE path WHEN 'nation.parquet' THEN 'size_mismatch' WHEN 'supplier.parquet' THEN 'checksum_mismatch' WHEN 'lost.parquet' THEN 'missing' ELSE 'ok' END AS status FROM (VALUES "
        + ", ".join(f"('{n}.parquet')" for n in (*TABLES, "lost")) + ") AS v(path)",
    "candidate_statuses": sql("SELECT c.candidate_id, m.status AS comparison_status, r.status AS clinical_review_status FROM cand c JOIN cmp m ON c.candidate_id = m.text_candidate_id JOIN rev r ON c.candidate_id = r.candidate_id WHERE c.ed = 'text'"),
    "blocking_issues": sql("SELECT count(*) AS blocking_issues FROM iss"),
    "dose_like_pages": sql("SELECT source_id, physical_page, n_signals, signals FROM dose WHERE ed = 'text'"),
    "dose_islands": sql("SELECT source_id, island, count(*) AS n_pages, min(physical_page) AS first_page FROM isl WHERE ed = 'text' GROUP BY ALL"),
    "dose_candidates": sql(f"SELECT {_CAND} FROM cand WHERE ed = 'text'"),
    "heading_as_of": sql("""SELECT p.source_id, p.physical_page, arg_max(section_number, (h.physical_page, line_index)) AS heading_section
      FROM ipages p LEFT JOIN heads h ON p.source_id = h.source_id AND h.physical_page <= p.physical_page GROUP BY ALL"""),
    "dose_coverage": sql("SELECT source_id, physical_page, 'unaccounted_dose_page' AS code, 'dose-like page ' || physical_page || ' is not assigned to a candidate or dismissal' AS message FROM uncov"),
    "normalize_text": sql("SELECT candidate_id, sha256(normal) AS normal_sha256 FROM norm WHERE ed = 'text'"),
    "protected_tokens": sql("SELECT n.candidate_id, coalesce(placed, '') AS placed FROM norm n LEFT JOIN prot ON n.candidate_id = prot.candidate_id WHERE ed = 'text'"),
    "heading_alignment": sql("SELECT source_id, physical_page, line_index::BIGINT AS line_index, text_section, n_illustrated, status FROM ali"),
    "candidate_comparison": sql("SELECT text_candidate_id, illustrated_candidate_id, status FROM cmp"),
    "comparison_issues": sql("SELECT regexp_replace(message, ' has comparison status .*', '') AS text_candidate_id, code, message FROM iss WHERE code LIKE 'dose\\_%' ESCAPE '\\'"),
    "apply_reviews": sql("SELECT candidate_id, status, CASE status WHEN 'stale' THEN 'stale_clinical_review' WHEN 'conflict' THEN 'conflicting_clinical_review' END AS code FROM rev"),
    "cadre_report": sql("SELECT * FROM rep"),
    "issue_list": sql("SELECT cadre, code, message FROM iss"),
    "run_summary": sql("""SELECT p.source_id, sha256(p.source_id) AS sha256, p.n AS pages, coalesce(h.n, 0) AS headings, coalesce(c.n, 0) AS dose_candidates
      FROM (SELECT source_id, count(*) AS n FROM pages GROUP BY 1) p LEFT JOIN (SELECT source_id, count(*) AS n FROM heads GROUP BY 1) h ON p.source_id = h.source_id
      LEFT JOIN (SELECT source_id, count(*) AS n FROM cand GROUP BY 1) c ON p.source_id = c.source_id"""),
    "bbox_pages": sql("""SELECT source_id, row_number() OVER (PARTITION BY source_id ORDER BY physical_page) AS nth, len(string_split(layout_text, chr(10)))::BIGINT AS n_lines,
      len(string_split(replace(layout_text, chr(10), ' '), ' '))::BIGINT AS n_words, replace(layout_text, chr(10), ' ') AS words FROM pages WHERE physical_page > 0"""),
    "config_validation": """WITH p AS (SELECT 'c' || (c_custkey % 400) AS cadre, 'm' || c_custkey || '-text' AS text, 'm' || CASE WHEN c_custkey % 9 = 0 THEN c_custkey + 1 ELSE c_custkey END || '-illustrated' AS illustrated FROM customer),
      m AS (SELECT 'm' || c_custkey || '-' || side AS path, 'c' || CASE WHEN c_custkey % 17 = 0 THEN 401 ELSE c_custkey % 400 END AS cadre, CASE WHEN c_custkey % 19 = 0 THEN 'text' ELSE side END AS representation
        FROM customer, (VALUES ('text'), ('illustrated')) AS v(side) WHERE c_custkey % 13 <> 0),
      u AS (SELECT cadre, 'text' AS side, text AS path FROM p UNION ALL SELECT cadre, 'illustrated', illustrated FROM p)
      SELECT 'duplicate_cadre' AS code, cadre AS subject FROM p GROUP BY cadre HAVING count(*) > 1
      UNION ALL SELECT 'manifest_path_reused', path FROM u GROUP BY path HAVING count(*) > 1
      UNION ALL SELECT CASE WHEN m.cadre IS NULL THEN 'missing_manifest' WHEN m.cadre <> u.cadre THEN 'manifest_cadre_mismatch' ELSE 'invalid_representation' END, u.path
        FROM u LEFT JOIN m ON u.path = m.path WHERE m.cadre IS NULL OR m.cadre <> u.cadre OR m.representation <> u.side""",
    "semantic_digest": sql("""SELECT source_id, sha256(unhex(string_agg(printf('%016X', strlen(path)) || hex(path) || printf('%016X', strlen(layout_text)) || hex(layout_text), '' ORDER BY path))) AS digest
      FROM (SELECT source_id, 'pages/' || physical_page AS path, layout_text FROM pages) AS f GROUP BY source_id"""),
    "candidate_jsonl": sql("""SELECT candidate_id, '{"schema_version":1,"candidate_id":"' || candidate_id || '","source_id":"' || source_id || '","heading_section":' || coalesce('"' || heading_section || '"', 'null')
      || ',"physical_pages":[' || pages || '],"printed_page_labels":[' || coalesce('"' || replace(labels, ',', '","') || '"', '') || '],"comparison_status":"not_compared"}' AS line FROM cand WHERE ed = 'text'"""),
    "cadre_markdown": sql("""SELECT cadre, '# ' || cadre || ' comparison' || chr(10) || chr(10) || '- Dose-like pages: ' || dose_like_pages || chr(10) || '- Accounted: ' || dose_pages_accounted || chr(10)
      || '- Unaccounted: ' || dose_pages_unaccounted || chr(10) || '- Dose candidates: ' || dose_candidates || chr(10) || '- Pending clinical review: ' || pending_clinical_review || chr(10)
      || '- Content mismatches: ' || content_mismatches || chr(10) AS markdown FROM rep"""),
}
