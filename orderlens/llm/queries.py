"""Queries of the training-data operators and, where SQL can express them, their SQL."""

from orderlens.llm import (
    decontamination,
    exact_dedup,
    language_id,
    language_model,
    merkle,
    mixing,
    packing,
    quality,
    sharding,
    simhash,
    substring_dedup,
    toxicity,
    variants,
)

QUERIES = {
    "op1_simhash": simhash.op1_simhash,
    "op2_mixing": mixing.op2_mixing,
    "op3_exact_dedup": exact_dedup.op3_exact_dedup,
    "op4_quality": quality.op4_quality,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_sharding": sharding.op6_sharding,
    "op7_lm_scoring": language_model.op7_lm_scoring,
    "op8_substring_dedup": substring_dedup.op8_substring_dedup,
    "op9_language_id": language_id.op9_language_id,
    "op10_decontamination": decontamination.op10_decontamination,
    "op11_merkle": merkle.op11_merkle,
    "op12_packing": packing.op12_packing,
    "op13_variants": variants.op13_variants,
}

ORACLE_SQL = {
    "op2_mixing": mixing.OP2_SQL,
    "op3_exact_dedup": exact_dedup.OP3_SQL,
    "op11_merkle": merkle.OP11_SQL,
    "op13_variants": variants.OP13_SQL,
}
