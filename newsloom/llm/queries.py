"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from newsloom.llm import alignment, embeddings, manifest, mixing, near_dedup, packing, pages, ppm, quality, secret_scan, substrings, token_files, toxicity

QUERIES = {
    "op1_token_files": token_files.token_output,
    "op2_near_dedup": near_dedup.near_dedup,
    "op3_quality_rules": quality.quality_rules,
    "op4_embedding_dedup": embeddings.embedding_dedup,
    "op5_html_extraction": pages.html_extraction,
    "op6_source_mix": mixing.source_mix,
    "op7_best_fit_packing": packing.best_fit_packing,
    "op8_lm_scores": ppm.lm_scores,
    "op9_toxicity": toxicity.toxicity,
    "op10_substring_dedup": substrings.substring_dedup,
    "op11_secret_scan": secret_scan.secret_scan,
    "op12_merkle_manifest": manifest.merkle_manifest,
    "op13_token_alignment": alignment.token_alignment,
}

ORACLES = {"op6_source_mix": mixing.oracle_sql(), "op12_merkle_manifest": manifest.oracle_sql()}
