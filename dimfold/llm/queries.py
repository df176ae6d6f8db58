"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from dimfold.llm import ball_kmeans, best_fit_packing, edit_embedding, hard_negatives, html_extraction, language_id, pivot_search, ppm_scoring, quality_rules, simhash_dedup, source_mixing, toxicity, warc_archive

QUERIES = {
    "op1_quality_rules": quality_rules.query,
    "op2_pivot_search": pivot_search.query,
    "op3_simhash_dedup": simhash_dedup.query,
    "op4_html_extraction": html_extraction.query,
    "op5_best_fit_packing": best_fit_packing.query,
    "op6_language_id": language_id.query,
    "op7_toxicity": toxicity.query,
    "op8_ppm_scoring": ppm_scoring.query,
    "op9_source_mixing": source_mixing.query,
    "op10_warc_archive": warc_archive.query,
    "op11_hard_negatives": hard_negatives.query,
    "op12_ball_kmeans": ball_kmeans.query,
    "op13_edit_fingerprints": edit_embedding.query,
}

ORACLE = {
    "op1_quality_rules": quality_rules.ORACLE,
    "op2_pivot_search": pivot_search.ORACLE,
    "op9_source_mixing": source_mixing.ORACLE,
    "op10_warc_archive": warc_archive.ORACLE,
    "op11_hard_negatives": hard_negatives.ORACLE,
    "op12_ball_kmeans": ball_kmeans.ORACLE,
}
