"""Registered queries of the numbered operators and their DuckDB SQL."""

from __future__ import annotations

from sparkrec.llm import (fingerprints, html_blocks, importance, jaccard, langid, mixing, packing, pii, quality, secrets, substrings, token_files,
                          vector_codes)

QUERIES = {
    "op1_language_id": langid.op1_language_id,
    "op2_suffix_dedup": substrings.op2_suffix_dedup,
    "op3_packing": packing.op3_packing,
    "op4_fingerprints": fingerprints.op4_fingerprints,
    "op5_mixing": mixing.op5_mixing,
    "op6_token_files": token_files.op6_token_files,
    "op7_host_quality": quality.op7_host_quality,
    "op8_jaccard_join": jaccard.op8_jaccard_join,
    "op9_pii": pii.op9_pii,
    "op10_secrets": secrets.op10_secrets,
    "op11_importance": importance.op11_importance,
    "op12_vector_codes": vector_codes.op12_vector_codes,
    "op13_main_text": html_blocks.op13_main_text,
}

ORACLE = {
    "op5_mixing": mixing.OP5_SQL,
    "op7_host_quality": quality.OP7_SQL,
    "op11_importance": importance.op11_importance,
    "op11_importance": importance.OP11_SQL,
    "op12_vector_codes": vector_codes.OP12_SQL,
}
