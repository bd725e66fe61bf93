"""Fixed record layouts (Spark DDL), enum domains and limits. JSON key order is column order."""

from __future__ import annotations

WORD = "struct<text:string,x_min:float,y_min:float,x_max:float,y_max:float>"
LINE = f"struct<x_min:float,y_min:float,x_max:float,y_max:float,words:array<{WORD}>>"
BLOCK = f"struct<x_min:float,y_min:float,x_max:float,y_max:float,lines:array<{LINE}>>"
BOUNDING_PAGE = f"struct<width:float,height:float,blocks:array<{BLOCK}>>"
SIGNAL = "struct<category:string,exact_text:string,line_index:bigint>"
ISSUE = "struct<code:string,blocking:boolean,message:string>"

MANIFEST = (
    "source_id string, title string, cadre string, edition string, representation string, official_url string, "
    "retrieved_at string, byte_size bigint, sha256 string, page_count bigint, local_path string"
)
CONFIG = "schema_version bigint, derived_path string, pairs array<struct<cadre:string,text:string,illustrated:string>>"
REVIEW = (
    "schema_version bigint, candidate_id string, content_hash string, text_source_id string, illustrated_source_id string, "
    "reviewer string, reviewed_at string, decision string, notes string"
)
PAGE_FIELDS = [
    "schema_version", "source_id", "physical_page", "printed_page_label", "width", "height", "layout_text", "blocks",
    "header_candidates", "footer_candidates", "normalized_content_hash", "warnings",
]
HEADING_FIELDS = ["schema_version", "source_id", "section_number", "exact_title", "normalized_title", "level", "physical_page", "printed_page_label"]
DOSE_PAGE_FIELDS = ["source_id", "physical_page", "signals"]
CANDIDATE_FIELDS = [
    "schema_version", "candidate_id", "source_id", "heading_section", "physical_pages", "printed_page_labels", "exact_text",
    "content_hash", "signals", "comparison_status", "clinical_review_status",
]
REPORT_FIELDS = [
    "cadre", "heading_alignments", "heading_issues", "dose_like_pages", "dose_pages_accounted", "dose_pages_unaccounted",
    "dose_candidates", "content_mismatches", "approved_dose_candidates", "pending_clinical_review", "issues",
]

# The strings that records hold on disk.
CADRES = ["JCHEW", "CHEW", "CHO"]
REPRESENTATIONS = ["text", "illustrated"]
DECISIONS = ["approved", "rejected", "needs_correction", "not_a_dosing_table"]
COMPARISON_STATUSES = {
    "not_compared": "NotCompared",
    "match": "Match",
    "format_only_difference": "FormatOnlyDifference",
    "content_mismatch": "ContentMismatch",
    "missing_in_text": "MissingInText",
    "missing_in_illustrated": "MissingInIllustrated",
    "ambiguous_alignment": "AmbiguousAlignment",
    "extraction_error": "ExtractionError",
}
REVIEW_STATUSES = ["pending_clinical_review", "approved", "rejected", "needs_correction", "not_a_dosing_table", "stale", "conflict"]
CERTIFICATION_STATUSES = ["reference_only", "in_review", "guided", "rejected"]
OFFICIAL_PREFIX = "https://chprbn.gov.ng/"

# Limits that other parts of the product state.
RUNTIME_CADRES = ["JCHEW", "CHEW"]
INFERENCE_LIMITS = {"context_tokens": 2048, "output_tokens": 180, "temperature": 0.0}
PERFORMANCE_BUDGET = {"min_tokens_per_second": 15.0, "max_total_rss_mb": 6656, "max_shell_rss_mb": 400, "max_temperature_c": 85.0, "max_warm_latency_ms": 8000}


def allows_composed_action(status: str) -> bool:
    """Only a guided certification does."""
    return status == "guided"
