import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from paperlode.functions import patterns, text
from paperlode.operators import comparison, doses, headings, pages, report, review
from paperlode.plans import queries
from paperlode.schemas import CANDIDATE_FIELDS, REVIEW, allows_composed_action
from paperlode.sources import tables
from paperlode.streaming import pages as stream


def records(spark, layouts, source="demo-text", first=1):
    df = spark.createDataFrame([(source, first + i, x) for i, x in enumerate(layouts)], "source_id string, physical_page long, layout_text string")
    return pages.describe_pages(df)


def test_page_fields(spark):
    rows = records(spark, ["see page 12\nPAGE 7\nx\ny", "PAGE\n7", "xPAGE 9", ""]).orderBy("physical_page").collect()
    assert [r.printed_page_label for r in rows] == ["12", "7", None, None]
    assert [r.warnings for r in rows] == [[], [], ["missing_printed_page_label"], ["missing_printed_page_label"]]
    assert rows[0].header_candidates == ["see page 12", "PAGE 7", "x"] and rows[0].footer_candidates == ["y", "x", "PAGE 7"]
    assert rows[3].header_candidates == [] and len(rows[3].normalized_content_hash) == 64


@pytest.mark.parametrize(("layout", "n", "ok"), [("a\fb\f", 2, True), ("a\f\f", 2, True), ("a\f", 2, False), ("", 0, True)])
def test_pages_meet_boxes(spark, layout, n, ok):
    box = F.struct(F.lit(1.0).cast("float").alias("width"), F.lit(2.0).cast("float").alias("height"), F.array().cast(f"array<{pages.BLOCK}>").alias("blocks"))
    df = spark.range(1).select(F.lit("s").alias("source_id"), F.lit(layout).alias("layout_text"), F.array_repeat(box, n).alias("bounding_pages"))
    if ok:
        assert pages.build_page_records(df).count() == n
    else:
        with pytest.raises(Exception, match="invalid extraction output"):
            pages.build_page_records(df).collect()


def test_headings(spark):
    p = records(spark, ["SECTION TWO\n2.3.1 SIMPLE FEVER\n2.5 mL 8 hourly\n5 10\n3 Fever\n3. FEVER \n1.2.3.4.5 X", "2.2 EARLIER TOPIC\n2.2 EARLIER TOPIC"])
    h = headings.extract_headings(p)
    rows = h.orderBy("physical_page", "line_index").collect()
    assert [(r.section_number, r.exact_title, r.level) for r in rows] == [
        ("SECTION TWO", "SECTION TWO", "section"), ("2.3.1", "SIMPLE FEVER", "numbered"), ("2.5", "mL 8 hourly", "numbered"), ("5", "10", "numbered"),
        ("3", "FEVER", "numbered"), ("2.2", "EARLIER TOPIC", "numbered"), ("2.2", "EARLIER TOPIC", "numbered"),
    ]
    issues = headings.validate_heading_hierarchy(h).orderBy("physical_page", "line_index").collect()
    assert [r.issue.message.split()[0] for r in issues] == ["3", "2.2"]
    assert {r.issue.code for r in issues} == {"hierarchy_regression"} and all(r.issue.blocking for r in issues)


def test_number_order(spark):
    p = records(spark, ["\n".join(f"{n} A" for n in ["2.3.1", "2.2", "2.2", "2.2.1", "2", "99999999999.1"])])
    got = headings.validate_heading_hierarchy(headings.extract_headings(p)).orderBy("line_index").collect()
    assert [r.issue.message.split()[0] for r in got] == ["2.2", "2", "99999999999.1"]


def test_references(spark):
    body = records(spark, ["2.3 FEVER\nPAGE 53", "2.3.1 SIMPLE FEVER\nPAGE 54", "2.9 SAME", "2.9 SAME", "2.7 NO LABEL"], first=53)
    toc = records(spark, ["TABLE of contents\n2.3 FEVER ..... 53\n2.3.1 SIMPLE FEVER 99\n2.8 GONE 1\n2.9 SAME 2\n2.7 NO LABEL 3"], first=3)
    both = body.union(toc)
    refs = headings.extract_toc_references(both)
    assert refs.orderBy("line_index").first().title == "FEVER ....."
    got = headings.validate_heading_references(headings.extract_headings(both), refs).orderBy("line_index").collect()
    assert [r.issue and (r.issue.code, r.issue.message) for r in got] == [
        None, ("page_reference_mismatch", '2.3.1 points to 99, heading is on Some("54")'), ("missing_heading", "2.8 is referenced by the TOC but missing"),
        ("duplicate_heading", "2.9 resolves to multiple headings"), ("page_reference_mismatch", "2.7 points to 3, heading is on None"),
    ]


DOSING = ["2.3 FEVER\nAmoxicillin 125 mg/5 mL: give 2.5 mL 8 hourly for 5 days", "Weight 5-14 kg\nGive 5 mg/kg IM stat\nAge 2-11 months", "Plain prose."]


def grouped(spark, layouts, source="demo-text", first=1):
    p = records(spark, layouts, source, first)
    return doses.group_dose_candidates(p, headings.extract_headings(p), doses.detect_dose_like_pages(p))


def test_candidates(spark):
    p = records(spark, DOSING)
    found = doses.detect_dose_like_pages(p).orderBy("physical_page").collect()
    assert [[(s.line_index, s.category, s.exact_text.strip()) for s in r.signals] for r in found] == [
        [(1, "strength", "125 mg/5 mL"), (1, "strength", "2.5 mL"), (1, "timing", "8 hourly"), (1, "timing", "for 5 days")],
        [(0, "band", "Weight 5-14 kg"), (1, "strength", "5 mg/kg"), (1, "timing", "stat"), (1, "route", "IM"), (2, "band", "Age 2-11 months")],
    ]
    (c,) = grouped(spark, DOSING).collect()
    assert c.asDict().keys() == set(CANDIDATE_FIELDS)
    assert (c.heading_section, c.physical_pages, len(c.signals)) == ("2.3", [1, 2], 9)
    assert (c.comparison_status, c.clinical_review_status) == ("not_compared", "pending_clinical_review")
    assert c.candidate_id == f"dose-demo-text-1-{c.content_hash[:16]}" and c.exact_text == DOSING[0] + "\n\f\n" + DOSING[1]


def test_late_heading_and_quirks(spark):
    rows = grouped(spark, ["5 girls", "", "Give 5 mg\n4.1 LATER ON THE PAGE"]).orderBy("physical_pages").collect()
    assert [(r.heading_section, r.signals[0].exact_text) for r in rows] == [(None, "5 g"), ("4.1", "5 mg")]


def test_coverage(spark):
    dose = doses.detect_dose_like_pages(records(spark, DOSING))
    none = grouped(spark, DOSING).limit(0)
    got = doses.validate_dose_coverage(dose, none).orderBy("physical_page").collect()
    assert [r.issue.code for r in got] == ["unaccounted_dose_page"] * 2
    assert got[0].issue.message == "dose-like page 1 is not assigned to a candidate or dismissal"
    dismissed = spark.createDataFrame([(1,)], "physical_page long")
    assert [r.physical_page for r in doses.validate_dose_coverage(dose, none, dismissed).collect()] == [2]
    assert doses.validate_dose_coverage(dose, grouped(spark, DOSING)).count() == 0


SENTENCE = "Amoxicillin 2.5 mL IM 8 hourly for 5 days weight 5-14 kg REFER; do not repeat"
CHANGES = [("2.5", "5"), ("mL", "mg"), ("IM", "oral"), ("8", "6"), ("5 days", "7 days"), ("5-14", "5-15"), ("REFER; do not", "; ")]


def test_comparison(spark):
    def status(a, b):
        return [r.status for r in comparison.compare_candidates(grouped(spark, a), grouped(spark, b, "demo-illustrated")).collect()]

    for old, new in CHANGES:
        assert status([f"2.3 FEVER\n{SENTENCE}"], [f"2.3 FEVER\n{SENTENCE.replace(old, new)}"]) == ["content_mismatch"], old
    assert status([SENTENCE], [SENTENCE]) == ["match"]  # neither has a heading
    assert status([SENTENCE], [SENTENCE.replace("weight", "weight:").replace(" ", "  ")]) == ["format_only_difference"]
    assert status([SENTENCE], ["2.3 FEVER\n" + SENTENCE]) == ["missing_in_illustrated"]
    assert status([SENTENCE], [SENTENCE, "", SENTENCE]) == ["ambiguous_alignment"]


def test_alignment_and_issues(spark):
    one = headings.extract_headings(records(spark, ["2.3 FEVER\n2.4 ONLY HERE"]))
    two = headings.extract_headings(records(spark, ["2.3 Fever", "2.3 FEVER"], "demo-illustrated"))
    got = comparison.align_headings(one, two).orderBy("line_index").collect()
    assert [(r.status, r.illustrated_sections) for r in got] == [("ambiguous", ["2.3", "2.3"]), ("missing", [])]
    c = spark.createDataFrame([("a", "content_mismatch"), ("b", "missing_in_illustrated"), ("c", "match")], "text_candidate_id string, status string")
    assert sorted(r.issue.code + "|" + r.issue.message for r in comparison.comparison_issues(c).collect()) == [
        "dose_contentmismatch|a has comparison status ContentMismatch", "dose_missinginillustrated|b has comparison status MissingInIllustrated",
    ]


GOOD = dict(schema_version=1, candidate_id="c", content_hash="h" * 64, text_source_id="demo-text", illustrated_source_id="demo-illustrated", reviewer="r", reviewed_at="2026-01-01", decision="approved", notes="n")


@pytest.mark.parametrize(
    ("records_", "want"),
    [
        ([], "pending_clinical_review"), ([{}], "approved"), ([{}, {}], "approved"), ([{"content_hash": "x" * 64}], "stale"), ([{}, {"decision": "rejected"}], "conflict"),
        ([{}, {"content_hash": "x" * 64, "decision": "rejected"}], "approved"), ([{"decision": "not_a_dosing_table"}], "not_a_dosing_table"), ([{"decision": "needs_correction"}], "needs_correction"),
        *(([bad], "conflict") for bad in ({"schema_version": 2}, {"reviewer": " "}, {"notes": ""}, {"reviewed_at": "2026"}, {"text_source_id": "x"}, {"illustrated_source_id": "x"})),
    ],
)
def test_reviews(spark, records_, want):
    c = spark.createDataFrame([("c", "h" * 64, "demo-text")], "candidate_id string, content_hash string, source_id string")
    (row,) = review.apply_reviews(c, spark.createDataFrame([GOOD | r for r in records_], REVIEW)).collect()
    assert row.status == want
    assert (row.issue and row.issue.code) == {"stale": "stale_clinical_review", "conflict": "conflicting_clinical_review"}.get(want)


def test_markdown():
    row = dict.fromkeys(report.REPORT_FIELDS, 3) | {"cadre": "CHO", "issues": [{"code": "x", "blocking": True, "message": "m"}, {"code": "y", "blocking": False, "message": "m"}]}
    told = report.run_markdown({"poppler_version": "1", "sources": [{"source_id": "s", "sha256": "h", "pages": 1, "headings": 2, "dose_candidates": 3}], "comparisons": [row]})
    assert told.count("\n## ") == 6 and told.endswith("## Blocking issues\n\n- `x`: m\n") and "- CHO: 3 of 3 candidates pending\n" in told
    assert allows_composed_action("guided") and not allows_composed_action("in_review")


def test_stream(spark, tmp_path):
    spark.createDataFrame([("s", i + 1, x) for i, x in enumerate(DOSING)], stream.PAGES).write.parquet(f"{tmp_path}/in")
    q = stream.stream_dose_like_pages(stream.read_pages(spark, f"{tmp_path}/in")).writeStream.format("memory").queryName("dose").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert sorted(r.physical_page for r in spark.table("dose").collect()) == [1, 2]


def test_signals_of_a_page_are_found_once(spark):
    plan = doses.detect_dose_like_pages(records(spark, DOSING))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all(") == 2 * len(patterns.SIGNALS)  # those for ASCII texts, and the others


def test_ascii_texts_have_the_tokens_and_signals_of_others(spark):
    parts = ["5", "12.5.3", " ", "\n", "\t", "-", "/", "%", "mg", "G", "ml", "IU", "stat", "hourly", "for 5 days", "AGE", "weight", "Years", "oral", "im", "sc", "x", "_", "NOT", "abc"]
    rng = random.Random(5)
    texts = [(i, "".join(rng.choices(parts, k=rng.randint(0, 20)))) for i in range(3000)]
    df = spark.createDataFrame(texts, "i long, t string").select("i", "t", doses.signals(F.col("t")).alias("s"), text.protected_words(F.upper("t")).alias("w"), text.protected_tokens(F.upper("t")).alias("p"))
    for r in df.collect():
        want = [(c, m, i) for i, x in enumerate(r.t.removesuffix("\n").split("\n") if r.t else []) for c, p in patterns.SIGNALS.items() for m in re.findall(p.replace("(?iUd)", "(?i)"), x)]
        assert [(s.category, s.exact_text, s.line_index) for s in r.s] == want, r.t
        assert r.w == [x.normalized for x in r.p], r.t


def test_larger_tables_are_dealt_to_more_tasks(spark, monkeypatch):
    """The number of tasks goes with the input; results don't depend on it."""
    folder = "/root/testdata/sf0.001"
    jobs = {q: lambda q=q: queries.QUERIES[q](spark, folder) for q in ("lines", "dose_candidates", "hierarchy_regressions")}
    few = {q: sorted(map(str, job().collect())) for q, job in jobs.items()}
    monkeypatch.setattr(tables, "TASK_BYTES", 5_000)  # fewer than part has, too
    for q, job in jobs.items():
        df = job()
        assert sorted(map(str, df.collect())) == few[q]
        assert "hashpartitioning(l_partkey" in df._jdf.queryExecution().toString() or q != "lines"
        assert "REPARTITION_BY_NUM" in df._jdf.queryExecution().executedPlan().toString(), q


def test_document_signals_of_all_texts_equal_brute_force(spark, tmp_path):
    texts = ["give 5 mg oral", "é5 mg, 5 mgé; 3–5 años", "Für 3–5 years: ٥ ml IM, stat.", "5 mg/10 kg\nweight 3 - 4 Kg très oral", "日本語 10 mg IV", "crème", "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = Counter()
    for i, t in enumerate(texts):
        for line in (t or "").split("\n"):
            want.update({(i, c): n for c, p in patterns.SIGNALS.items() if (n := len(re.findall(p.replace("(?iUd)", "(?i)"), line)))})
    rows = queries.q_document_signals(spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.category): r.n for r in rows} == want
    assert len({i for i, _ in want}) > 3
