"""Registered queries of the llm subpackage and their SQL."""

from tessera.llm import language_id, merkle, mixing, near_dedup, packing, quality, substring_dedup, token_counts, toxicity, url_filter

QUERIES = {
    "op1_minhash_near_dedup": near_dedup.op1_minhash_near_dedup,
    "op2_url_filters": url_filter.op2_url_filters,
    "op3_substring_dedup": substring_dedup.op3_substring_dedup,
    "op4_token_counts": token_counts.op4_token_counts,
    "op5_packing": packing.op5_packing,
    "op6_quality_rules": quality.op6_quality_rules,
    "op7_language_id": language_id.op7_language_id,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_fingerprints": merkle.op9_fingerprints,
    "op10_mixing": mixing.op10_mixing,
}

#: The others have no SQL form that is practical on whole tables; tests hold them against brute force.
ORACLE_SQL = {
    "op2_url_filters": url_filter.OP2_SQL,
    "op6_quality_rules": quality.OP6_SQL,
    "op10_mixing": mixing.OP10_SQL,
}
