"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from driftline.llm import bpe, exact_dedup, html_text, mixing, ngram_join, quality, resampling, secrets, simhash, substring, token_store, toxicity, vector_codes

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_token_store": token_store.op2_token_store,
    "op3_substring": substring.op3_substring,
    "op4_exact_dedup": exact_dedup.op4_exact_dedup,
    "op5_mixing": mixing.op5_mixing,
    "op6_html": html_text.op6_html,
    "op7_quality": quality.op7_quality,
    "op8_bpe": bpe.op8_bpe,
    "op9_simhash": simhash.op9_simhash,
    "op10_secrets": secrets.op10_secrets,
    "op11_vector_codes": vector_codes.op11_vector_codes,
    "op12_resampling": resampling.op12_resampling,
    "op13_ngram_join": ngram_join.op13_ngram_join,
}

ORACLE_SQL = {
    "op3_substring": substring.OP3_SQL,
    "op4_exact_dedup": exact_dedup.OP4_SQL,
    "op11_vector_codes": vector_codes.OP11_SQL,
    "op12_resampling": resampling.OP12_SQL,
    "op13_ngram_join": ngram_join.OP13_SQL,
}
