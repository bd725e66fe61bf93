"""Dosing signals, pages that look like dosing, and candidates of consecutive such pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns, text
from ..schemas import CANDIDATE_FIELDS, SIGNAL
from ..sources.tables import spread


def signals(layout: Column) -> Column:
    """array of (category, exact_text, line_index), by line, then by category, then by place."""

    def of_line(line: Column, i: Column, found: dict[str, str]) -> Column:
        def of(category: str, pattern: str) -> Column:
            found = F.regexp_extract_all(line, F.lit(pattern), F.lit(0))
            return F.transform(found, lambda m: F.struct(F.lit(category).alias("category"), m.alias("exact_text"), i.cast("long").alias("line_index")))

        return F.concat(*(of(*x) for x in found.items()))

    none = F.array().cast(f"array<{SIGNAL}>")
    rows = text.lines(layout)
    ascii_line = lambda x, i: F.when(x.rlike(patterns.ASCII_HINT), of_line(x, i, patterns.ASCII_SIGNALS)).otherwise(none)
    found = F.when(text.is_ascii(layout), F.transform(rows, ascii_line)).otherwise(F.transform(rows, lambda x, i: of_line(x, i, patterns.SIGNALS)))
    return F.flatten(found).cast(f"array<{SIGNAL}>")


#: What candidates need of their pages besides signals.
PAGE_TEXT = ("printed_page_label", "layout_text")


def detect_dose_like_pages(pages: DataFrame, keys: tuple[str, ...] = (), carry: tuple[str, ...] = ()) -> DataFrame:
    """Pages with a strength, or with two signals of any kind; carry: further columns that come along.
    No shuffle: each page is its own row."""
    # a filter of a further step would be moved before this one, which finds all signals again for each condition
    kept = F.filter(F.array(signals(F.col("layout_text"))), lambda s: F.exists(s, lambda x: x["category"] == "strength") | (F.size(s) >= 2))
    return pages.select(*keys, "source_id", "physical_page", F.explode(kept).alias("signals"), *carry)


def dose_islands(dose_pages: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """dose_pages with island, the same number for pages that follow one another in a source."""
    order = Window.partitionBy(*keys, "source_id").orderBy("physical_page")
    return dose_pages.withColumn("island", F.col("physical_page") - F.row_number().over(order))


def heading_as_of(places: DataFrame, headings: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """places (source_id, physical_page) with heading_section: the last heading of the source on
    that page, wherever on it, or before. One pass over both in page order."""
    on = [*keys, "source_id"]
    marks = headings.select(*on, "physical_page", "line_index", F.col("section_number").alias("mark"), F.lit(None).cast("struct<x:int>").alias("none"))
    rest = [c for c in places.columns if c not in (*on, "physical_page")]
    asks = places.select(*on, "physical_page", F.struct(F.lit(1).alias("one"), *rest).alias("ask"))
    both = spread(marks.drop("none").unionByName(asks, allowMissingColumns=True), *on)
    order = Window.partitionBy(*on).orderBy("physical_page", F.col("ask").isNotNull(), "line_index").rowsBetween(Window.unboundedPreceding, 0)
    rows = both.withColumn("heading_section", F.last("mark", ignorenulls=True).over(order)).where("ask is not null")
    return rows.select(*on, "physical_page", *(F.col(f"ask.{c}").alias(c) for c in rest), "heading_section")


def group_dose_candidates(pages: DataFrame, headings: DataFrame, dose_pages: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """A candidate for each run of consecutive dose-like pages of a source. Dose pages that carry
    PAGE_TEXT are not joined with pages again."""
    on = [*keys, "source_id"]
    rows = dose_islands(spread(dose_pages, *on), keys)
    if not set(PAGE_TEXT) <= set(dose_pages.columns):
        rows = rows.join(pages.select(*on, "physical_page", *PAGE_TEXT), [*on, "physical_page"])
    page = F.struct("physical_page", "printed_page_label", "layout_text", "signals")
    runs = rows.groupBy(*on, "island").agg(F.sort_array(F.collect_list(page)).alias("run"), F.min("physical_page").alias("physical_page"))
    runs = runs.select(
        *on, "physical_page", F.array_join(F.transform("run", lambda p: p["layout_text"]), "\n\f\n").alias("exact_text"),
        F.transform("run", lambda p: p["physical_page"]).alias("physical_pages"),
        F.filter(F.transform("run", lambda p: p["printed_page_label"]), lambda x: x.isNotNull()).alias("printed_page_labels"),
        F.flatten(F.transform("run", lambda p: p["signals"])).alias("signals"),
    )
    runs = runs.withColumn("content_hash", F.sha2("exact_text", 256))
    found = heading_as_of(runs, headings, keys)
    name = F.concat(F.lit("dose-"), "source_id", F.lit("-"), "physical_page", F.lit("-"), F.substring("content_hash", 1, 16))
    return found.select(
        "*", name.alias("candidate_id"), F.lit(1).cast("long").alias("schema_version"), F.lit("not_compared").alias("comparison_status"),
        F.lit("pending_clinical_review").alias("clinical_review_status"),
    ).select(*keys, *CANDIDATE_FIELDS)


def validate_dose_coverage(dose_pages: DataFrame, candidates: DataFrame, dismissals: DataFrame | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """An issue for each dose-like page that is in no candidate and not dismissed. Pages are told
    apart by keys and physical_page only."""
    accounted = candidates.select(*keys, F.explode("physical_pages").alias("physical_page"))
    if dismissals is not None:
        accounted = accounted.union(dismissals.select(*keys, "physical_page"))
    left = dose_pages.join(accounted.distinct(), [*keys, "physical_page"], "left_anti")
    message = F.concat(F.lit("dose-like page "), "physical_page", F.lit(" is not assigned to a candidate or dismissal"))
    return left.select(*keys, "source_id", "physical_page", text.issue("unaccounted_dose_page", message).alias("issue"))
