"""Registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from tidemark.llm import (byte_bpe, collocations, cross_alignment, embedding_dedup, exact_topk, html_extraction, quality,
                          simhash_dedup, source_mixing, substring_dedup, suffix_dedup, token_files, toxicity)

LLM_QUERIES = {
    "op1_substring_dedup": substring_dedup.query,
    "op1_substring_dedup_all_runs": substring_dedup.all_runs_query,
    "op1_substring_dedup_by_sentences": substring_dedup.query,
    "op1_substring_dedup_shortest_runs": substring_dedup.shortest_runs_query,
    "op2_exact_topk": exact_topk.query,
    "op3_quality_classifier": quality.query,
    "op4_source_mixing": source_mixing.query,
    "op5_byte_bpe": byte_bpe.query,
    "op6_embedding_near_dedup": embedding_dedup.query,
    "op7_toxicity": toxicity.query,
    "op8_simhash_near_dedup": simhash_dedup.query,
    "op9_suffix_array_dedup": suffix_dedup.query,
    "op10_token_output": token_files.query,
    "op11_html_extraction": html_extraction.query,
    "op12_collocations": collocations.query,
    "op13_tokenizer_alignment": cross_alignment.query,
}

LLM_SQL: dict[str, str] = {
    "op1_substring_dedup": substring_dedup.BY_SENTENCES_SQL,
    "op1_substring_dedup_all_runs": substring_dedup.ALL_RUNS_SQL,
    "op1_substring_dedup_by_sentences": substring_dedup.BY_SENTENCES_SQL,
    "op1_substring_dedup_shortest_runs": substring_dedup.SQL,
    "op2_exact_topk": exact_topk.SQL,
    "op4_source_mixing": source_mixing.sql(),
    "op6_embedding_near_dedup": embedding_dedup.SQL,
    "op12_collocations": collocations.SQL,
}
