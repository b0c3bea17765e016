"""The queries of the numbered operators and their oracle SQL."""

from __future__ import annotations

from . import decontaminate, jaccard_join, line_dedup, main_text, nbest_pieces, paragraph_sketch, period_runs, pii, suffix_dedup, token_alignment, token_files, toxicity, vp_search

_QUERIES = {
    "op1_main_text": main_text,
    "op2_pii": pii,
    "op3_vp_search": vp_search,
    "op4_nbest_pieces": nbest_pieces,
    "op5_jaccard_join": jaccard_join,
    "op6_line_dedup": line_dedup,
    "op7_decontaminate": decontaminate,
    "op8_suffix_dedup": suffix_dedup,
    "op9_toxicity": toxicity,
    "op10_token_files": token_files,
    "op11_period_runs": period_runs,
    "op12_token_alignment": token_alignment,
    "op13_paragraph_sketch": paragraph_sketch,
}


def queries():
    return {name: module.query for name, module in _QUERIES.items()}


def oracle_sql():
    return {name: sql for name, module in _QUERIES.items() if (sql := getattr(module, "ORACLE", None))}
