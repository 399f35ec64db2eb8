"""Queries of the subpackage and their SQL."""

from __future__ import annotations

from martloom.llm import bpe, conversations, decontaminate, html, jaccard, language_model, quality, rules, substrings, toxicity, urls, warc, whitening

QUERIES = {
    "op1_substring_dedup": substrings.op1_substring_dedup,
    "op2_quality_rules": quality.op2_quality_rules,
    "op3_jaccard_join": jaccard.op3_jaccard_join,
    "op4_url_filter": urls.op4_url_filter,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_quality_classifier": rules.op6_quality_classifier,
    "op7_decontaminate": decontaminate.op7_decontaminate,
    "op8_warc": warc.op8_warc,
    "op9_main_text": html.op9_main_text,
    "op10_bpe": bpe.op10_bpe,
    "op11_embedding_whitening": whitening.op11_embedding_whitening,
    "op12_lm_scoring": language_model.op12_lm_scoring,
    "op13_conversation_repair": conversations.op13_conversation_repair,
}

ORACLE = {"op4_url_filter": urls.ORACLE, "op8_warc": warc.ORACLE}
