"""Queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from riverwatch.llm import (
    attribution, lexical, lines, manifest, mixing, neighbours, orc_tokens, packing, quality, secrets,
    sharding, simhash, substrings,
)

QUERIES = {
    "op1_substring_dedup": substrings.op1_substring_dedup,
    "op2_sharding": sharding.op2_sharding,
    "op3_nearest_neighbours": neighbours.op3_nearest_neighbours,
    "op4_simhash_near_dedup": simhash.op4_simhash_near_dedup,
    "op5_secret_scans": secrets.op5_secret_scans,
    "op6_best_fit_packing": packing.op6_best_fit_packing,
    "op7_mixing_sources": mixing.op7_mixing_sources,
    "op8_quality_rules": quality.op8_quality_rules,
    "op9_token_counts": attribution.op9_token_counts,
    "op10_token_id_output": orc_tokens.op10_token_id_output,
    "op11_ranked_lexical_search": lexical.op11_ranked_lexical_search,
    "op12_line_dedup": lines.op12_line_dedup,
    "op13_merkle_manifest": manifest.op13_merkle_manifest,
}

ORACLE_SQL = {
    "op3_nearest_neighbours": neighbours.ORACLE,
    "op7_mixing_sources": mixing.ORACLE,
    "op8_quality_rules": quality.ORACLE,
    "op11_ranked_lexical_search": lexical.ORACLE,
    "op12_line_dedup": lines.ORACLE,
    "op13_merkle_manifest": manifest.ORACLE,
}
