"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from geolith.llm import exact_dedup, license_scan, media_chunks, mixing, near_dedup, neighbours, packing, quality, secret_scan, token_output, toxicity, vector_codes, whitening

QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_mixing": mixing.op2_mixing,
    "op3_quality_classifier": quality.op3_quality_classifier,
    "op4_secret_scan": secret_scan.op4_secret_scan,
    "op5_media_columns": media_chunks.op5_media_columns,
    "op6_license_scan": license_scan.op6_license_scan,
    "op7_token_output": token_output.op7_token_output,
    "op8_best_fit_packing": packing.op8_best_fit_packing,
    "op9_near_dedup": near_dedup.op9_near_dedup,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_whitening": whitening.op11_whitening,
    "op12_nearest_neighbours": neighbours.op12_nearest_neighbours,
    "op13_vector_codes": vector_codes.op13_vector_codes,
}

ORACLE_SQL = {"op1_exact_dedup": exact_dedup.ORACLE_SQL, "op9_near_dedup": near_dedup.ORACLE_SQL, "op12_nearest_neighbours": neighbours.ORACLE_SQL, "op13_vector_codes": vector_codes.ORACLE_SQL}
