"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from ledgerflow.llm import best_fit_packing, chat_formatting, html_extraction, jaccard_join, label_sharding, line_dedup, quality_rules, source_mixing, suffix_dedup, topk_search

QUERIES = {
    "op1_chat_formatting": chat_formatting.query,
    "op2_html_extraction": html_extraction.query,
    "op3_suffix_dedup": suffix_dedup.query,
    "op4_source_mixing": source_mixing.query,
    "op5_label_sharding": label_sharding.query,
    "op6_topk_search": topk_search.query,
    "op7_quality_rules": quality_rules.query,
    "op8_jaccard_join": jaccard_join.query,
    "op9_best_fit_packing": best_fit_packing.query,
    "op10_line_dedup": line_dedup.query,
}

ORACLES = {
    "op1_chat_formatting": chat_formatting.ORACLE_SQL,
    "op4_source_mixing": source_mixing.ORACLE_SQL,
    "op6_topk_search": topk_search.ORACLE_SQL,
    "op7_quality_rules": quality_rules.ORACLE_SQL,
    "op8_jaccard_join": jaccard_join.ORACLE_SQL,
    "op10_line_dedup": line_dedup.ORACLE_SQL,
}
