"""The queries of this package by name, and the SQL of those that SQL can state."""

from __future__ import annotations

from tickloom.llm.bpe import op2_byte_bpe
from tickloom.llm.embeddings import op9_embedding_near_dedup
from tickloom.llm.filteraudit import OP13_SQL, op13_filter_audit
from tickloom.llm.linechunks import OP8_SQL, op8_line_chunks, op8_line_passages
from tickloom.llm.manifest import OP11_SQL, op11_merkle_manifest
from tickloom.llm.minmax import op10_min_max
from tickloom.llm.packing import op4_best_fit_packing
from tickloom.llm.pii import op6_personal_data
from tickloom.llm.prefixbpe import op12_prefix_bpe
from tickloom.llm.secrets import op3_secrets
from tickloom.llm.spotsigs import op7_spot_signatures
from tickloom.llm.suffixes import op1_suffix_dedup
from tickloom.llm.toxicity import op5_toxicity

QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_secrets": op3_secrets,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_toxicity": op5_toxicity,
    "op6_personal_data": op6_personal_data,
    "op7_spot_signatures": op7_spot_signatures,
    "op8_line_chunks": op8_line_chunks,
    "op8_line_passages": op8_line_passages,
    "op9_embedding_near_dedup": op9_embedding_near_dedup,
    "op10_min_max": op10_min_max,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_prefix_bpe": op12_prefix_bpe,
    "op13_filter_audit": op13_filter_audit,
}

ORACLES: dict[str, str] = {"op8_line_chunks": OP8_SQL, "op11_merkle_manifest": OP11_SQL, "op13_filter_audit": OP13_SQL}
