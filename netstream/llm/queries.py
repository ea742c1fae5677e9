"""The registered queries of this folder and their DuckDB SQL."""

from __future__ import annotations

from netstream.llm import (best_fit, decontaminate, fingerprint, language_id, language_model, line_dedup, near_dedup, packing,
                           quality, substring_dedup, url_filter, vector_codes, whitening)

QUERIES = {
    "op1_line_dedup": line_dedup.query,
    "op2_fingerprint": fingerprint.query,
    "op3_near_dedup": near_dedup.query,
    "op4_language_id": language_id.query,
    "op5_language_model": language_model.query,
    "op6_substring_dedup": substring_dedup.query,
    "op7_quality": quality.query,
    "op8_decontaminate": decontaminate.query,
    "op9_url_filter": url_filter.query,
    "op10_packing": packing.query,
    "op11_best_fit": best_fit.query,
    "op12_whitening": whitening.query,
    "op13_vector_codes": vector_codes.query,
}

SQL = {
    "op1_line_dedup": line_dedup.SQL,
    "op6_substring_dedup": substring_dedup.SQL,
    "op13_vector_codes": vector_codes.SQL,
}
