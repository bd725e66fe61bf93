"""Page operators on a stream.

Page records, headings and dosing signals depend on one page each, so the batch functions run on
a stream as they are. What needs a whole source (heading order, candidates) stays in batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.doses import detect_dose_like_pages
from ..operators.pages import describe_pages

PAGES = "source_id string, physical_page bigint, layout_text string"


def read_pages(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """Pages from Parquet files as they arrive in path."""
    return spark.readStream.schema(PAGES).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def stream_page_records(pages: DataFrame) -> DataFrame:
    return describe_pages(pages)


def stream_dose_like_pages(pages: DataFrame) -> DataFrame:
    return detect_dose_like_pages(pages)
