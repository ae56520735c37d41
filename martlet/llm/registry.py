"""The operators of this subpackage as named queries, and SQL for those that SQL can express."""

from __future__ import annotations

from martlet.llm import audit, circulant, exact, language, lloyd, markov, mixing, near, packing, pii, quality, sharding, vantage

QUERIES = {
    "op1_source_mixing": mixing.op1_source_mixing,
    "op2_skip_chain_pii": pii.op2_skip_chain_pii,
    "op3_vantage_point_search": vantage.op3_vantage_point_search,
    "op4_markov_secrets": markov.op4_markov_secrets,
    "op5_simhash_near_dedup": near.op5_simhash_near_dedup,
    "op6_best_fit_sharding": sharding.op6_best_fit_sharding,
    "op7_quality_classifier": quality.op7_quality_classifier,
    "op8_exact_dedup": exact.op8_exact_dedup,
    "op9_best_fit_packing": packing.op9_best_fit_packing,
    "op10_language_id": language.op10_language_id,
    "op11_resident_codes": lloyd.op11_resident_codes,
    "op12_circulant_minhash": circulant.op12_circulant_minhash,
    "op13_filter_audit": audit.op13_filter_audit,
}

ORACLE = {
    "op1_source_mixing": mixing.OP1_SQL,
    "op8_exact_dedup": exact.OP8_SQL,
    "op11_resident_codes": lloyd.OP11_SQL,
    "op12_circulant_minhash": circulant.OP12_SQL,
    "op13_filter_audit": audit.OP13_SQL,
}
