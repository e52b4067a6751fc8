"""The subpackage's registered queries and their SQL."""

from __future__ import annotations

import corpus_pipeline
from domainpulse.llm import (
    byte_bpe, embedding_dedup, exact_dedup, filter_audit, jaccard, license_scan, maxent_lm, mixing, sharding, suffix_dedup,
    token_files, toxicity, vector_codes,
)

QUERIES = {
    "op1_sharding": sharding.op1_sharding,
    "op2_token_files": token_files.op2_token_files,
    "op3_exact_dedup": exact_dedup.op3_exact_dedup,
    "op4_suffix_dedup": suffix_dedup.op4_suffix_dedup,
    "op5_byte_bpe": byte_bpe.op5_byte_bpe,
    "op6_license_scan": license_scan.op6_license_scan,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_embedding_dedup": embedding_dedup.op8_embedding_dedup,
    "op9_jaccard_join": jaccard.op9_jaccard_join,
    "op10_mixing": mixing.op10_mixing,
    "op11_filter_audit": filter_audit.op11_filter_audit,
    "op12_vector_codes": vector_codes.op12_vector_codes,
    "op13_lm_scoring": maxent_lm.op13_lm_scoring,
    "pipeline": corpus_pipeline.run,
}

ORACLE = {
    "op1_sharding": sharding.OP1_SQL,
    "op3_exact_dedup": exact_dedup.OP3_SQL,
    "op8_embedding_dedup": embedding_dedup.OP8_SQL,
    "op10_mixing": mixing.OP10_SQL,
    "op11_filter_audit": filter_audit.OP11_SQL,
    "op12_vector_codes": vector_codes.OP12_SQL,
}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
