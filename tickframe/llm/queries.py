"""The registered queries of the llm operators and their DuckDB SQL."""

from __future__ import annotations

from . import alignment, byte_bpe, chat, embedding_dedup, hard_negatives, language, licenses, near_dup, packing, quality, substring_dedup, token_counts, toxicity

QUERIES = {f.__name__: f for f in (
    packing.op1_packing, substring_dedup.op2_substring_dedup, near_dup.op3_near_dedup, licenses.op4_license_scan,
    quality.op5_quality_rules, token_counts.op6_token_counts, byte_bpe.op7_byte_bpe, language.op8_language_id,
    chat.op9_chat_format, embedding_dedup.op10_embedding_dedup, alignment.op11_tokenizer_alignment,
    hard_negatives.op12_hard_negatives, toxicity.op13_toxicity,
)}

SQL = {
    "op2_substring_dedup": substring_dedup.SQL,
    "op3_near_dedup": near_dup.SQL,
    "op4_license_scan": licenses.SQL,
    "op5_quality_rules": quality.SQL,
    "op9_chat_format": chat.SQL,
    "op10_embedding_dedup": embedding_dedup.SQL,
    "op12_hard_negatives": hard_negatives.SQL,
}
