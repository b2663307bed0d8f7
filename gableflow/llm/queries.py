"""Queries of the corpus operators and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from . import bpe, exact_dedup, lm, merkle, mixing, packing, pii, reputation, simhash, toxicity

QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_url_filter": reputation.op2_url_filter,
    "op3_pii": pii.op3_pii,
    "op4_mixing": mixing.op4_mixing,
    "op5_lm_scoring": lm.op5_lm_scoring,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_merkle": merkle.op7_merkle,
    "op8_token_counts": bpe.op8_token_counts,
    "op9_packing": packing.op9_packing,
    "op10_simhash": simhash.op10_simhash,
}

ORACLES = {
    "op1_exact_dedup": exact_dedup.ORACLE_SQL,
    "op2_url_filter": reputation.ORACLE_SQL,
    "op4_mixing": mixing.ORACLE_SQL,
}
