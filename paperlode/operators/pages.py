"""Page records from layout text and bounding boxes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import patterns, text
from ..schemas import BLOCK, PAGE_FIELDS


def split_layout(layout):
    """Pages of a layout text: cut at form feeds, without one empty page at the end."""
    parts = F.split(layout, "\f", -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)


def build_page_records(documents: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """A row for each page of documents (source_id, layout_text, bounding_pages, and keys).

    Pages are numbered from 1. The n-th page of the text belongs to the n-th bounding page; if their
    numbers differ the query fails.
    """
    pages = split_layout(F.col("layout_text"))
    told = F.concat(F.lit("invalid extraction output: layout has "), F.size(pages), F.lit(" pages, bounding boxes have "), F.size("bounding_pages"))
    zipped = F.arrays_zip(pages.alias("layout"), F.col("bounding_pages").alias("box"))
    checked = F.when(F.size(pages) == F.size("bounding_pages"), zipped).otherwise(F.raise_error(told))
    rows = documents.select(*keys, "source_id", F.posexplode(checked).alias("place", "page"))
    rows = rows.select(*keys, "source_id", (F.col("place") + 1).cast("long").alias("physical_page"), F.col("page.layout").alias("layout_text"), "page.box.*")
    return describe_pages(rows, keys)


def describe_pages(pages: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Page records for pages (source_id, physical_page, layout_text, and width, height and blocks
    if there are any): printed label, header and footer lines, content hash and warnings."""
    for name, kind in (("width", "float"), ("height", "float"), ("blocks", f"array<{BLOCK}>")):
        if name not in pages.columns:
            pages = pages.withColumn(name, F.lit(None).cast(kind))
    label = F.nullif(F.regexp_extract("layout_text", patterns.PAGE_LABEL, 1), F.lit(""))
    lines = text.lines(F.col("layout_text"))
    none = F.array().cast("array<string>")
    rows = pages.select(
        *keys, F.lit(1).cast("long").alias("schema_version"), "source_id", "physical_page", label.alias("printed_page_label"),
        "width", "height", "layout_text", "blocks", F.slice(lines, 1, 3).alias("header_candidates"),
        F.slice(F.reverse(lines), 1, 3).alias("footer_candidates"), F.sha2(text.collapse(F.col("layout_text")), 256).alias("normalized_content_hash"),
    )
    warnings = F.when(F.col("printed_page_label").isNull(), F.array(F.lit("missing_printed_page_label"))).otherwise(none)
    return rows.withColumn("warnings", warnings).select(*keys, *PAGE_FIELDS)


def page_lines(pages: DataFrame, *columns: str) -> DataFrame:
    """columns, line_index (from 0) and line of every line."""
    return pages.select(*columns, F.posexplode(text.lines(F.col("layout_text"))).alias("at", "line")).select(*columns, F.col("at").cast("long").alias("line_index"), "line")
