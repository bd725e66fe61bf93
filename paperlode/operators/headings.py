"""Headings, table-of-contents references, heading order and reference checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns, text
from ..schemas import HEADING_FIELDS
from ..sources.tables import spread
from .pages import page_lines


def is_toc_page(layout: Column) -> Column:
    return F.contains(F.upper(layout), F.lit(patterns.TOC_TITLE))


def extract_headings(pages: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """A row for each section or numbered heading outside of contents pages, with its line_index.

    A number without a dot counts only if its title is upper-case throughout.
    """
    lines = page_lines(pages.where(~is_toc_page(F.col("layout_text"))), *keys, "source_id", "physical_page", "printed_page_label")
    lines = lines.where(F.col("line").rlike(patterns.HEADING_HINT))
    bare = text.trim(F.col("line"))
    number, title = (F.regexp_extract("line", patterns.NUMBERED, i) for i in (1, 2))
    lines = lines.select("*", bare.alias("bare"), bare.rlike(patterns.SECTION).alias("is_section"), number.alias("number"), text.trim(title).alias("title"))
    numbered = (F.col("number") != "") & (F.contains("number", F.lit(".")) | (F.col("title") == F.upper("title")))
    rows = lines.where(F.col("is_section") | numbered)
    section = F.col("is_section")
    rows = rows.select(
        *keys, F.lit(1).cast("long").alias("schema_version"), "source_id",
        F.when(section, F.upper("bare")).otherwise(F.col("number")).alias("section_number"),
        F.when(section, F.col("bare")).otherwise(F.col("title")).alias("exact_title"),
        F.when(section, "section").otherwise("numbered").alias("level"), "physical_page", "printed_page_label", "line_index",
    )
    rows = rows.withColumn("normalized_title", text.normalize_title(F.col("exact_title")))
    return rows.select(*keys, *HEADING_FIELDS, "line_index")


def extract_toc_references(pages: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """section_number, title and printed_page_label of each entry on contents pages, in place order."""
    lines = page_lines(pages.where(is_toc_page(F.col("layout_text"))), *keys, "source_id", "physical_page")
    parts = [F.regexp_extract("line", patterns.TOC_ENTRY, i) for i in (1, 2, 3)]
    lines = lines.where(F.col("line").rlike(patterns.TOC_ENTRY))
    return lines.select(*keys, "source_id", parts[0].alias("section_number"), text.trim(parts[1]).alias("title"), parts[2].alias("printed_page_label"), "physical_page", "line_index")


def validate_heading_hierarchy(headings: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """An issue for each numbered heading whose number is less than that of the one right before."""
    order = Window.partitionBy(*keys, "source_id").orderBy("physical_page", "line_index")
    rows = spread(headings.where("level = 'numbered'"), *keys, "source_id").withColumn("parts", text.number_parts(F.col("section_number")))
    rows = rows.withColumn("before", F.lag("parts").over(order)).where(F.col("parts") < F.col("before"))
    message = F.concat("section_number", F.lit(" appears after a later numbered heading"))
    return rows.select(*keys, "source_id", "physical_page", "line_index", text.issue("hierarchy_regression", message).alias("issue"))


def validate_heading_references(headings: DataFrame, references: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """For each reference its section_number and an issue, which is null if one heading of that
    number is on the page that the reference names."""
    on = [*keys, "source_id", "section_number"]
    found = headings.groupBy(*on).agg(F.count("*").alias("found"), F.first("printed_page_label").alias("found_label"))
    rows = references.join(found, on, "left")
    number, label = F.col("section_number"), F.col("found_label")
    shown = F.coalesce(F.concat(F.lit('Some("'), label, F.lit('")')), F.lit("None"))
    problem = (
        F.when(F.col("found").isNull(), text.issue("missing_heading", F.concat(number, F.lit(" is referenced by the TOC but missing"))))
        .when(F.col("found") > 1, text.issue("duplicate_heading", F.concat(number, F.lit(" resolves to multiple headings"))))
        .when(~label.eqNullSafe(F.col("printed_page_label")), text.issue("page_reference_mismatch", F.concat(number, F.lit(" points to "), "printed_page_label", F.lit(", heading is on "), shown)))
    )
    return rows.select(*on, problem.alias("issue"), "physical_page", "line_index")
