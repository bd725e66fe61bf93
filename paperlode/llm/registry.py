"""Queries of this subpackage and the SQL that states the same results, where SQL can."""

from __future__ import annotations

from . import bpe, chat, decontaminate, lines, near_dedup, pii, quality, token_counts, topk, url_filters

QUERIES = {
    "op1_top_k": topk.op1_top_k,
    "op2_near_dedup": near_dedup.op2_near_dedup,
    "op3_line_dedup": lines.op3_line_dedup,
    "op4_pii": pii.op4_pii,
    "op5_token_counts": token_counts.op5_token_counts,
    "op6_decontamination": decontaminate.op6_decontamination,
    "op7_chat_formatting": chat.op7_chat_formatting,
    "op8_bpe": bpe.op8_bpe,
    "op9_quality_classifier": quality.op9_quality_classifier,
    "op10_url_filters": url_filters.op10_url_filters,
}
ORACLE_SQL = {
    "op1_top_k": topk.SQL,
    "op7_chat_formatting": chat.SQL,
    "op10_url_filters": url_filters.SQL,
}
