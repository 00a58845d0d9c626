"""Queries of the operators in this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from surfrank.llm import chat, decontaminate, divergence, extract_html, langid, mixing, neardup, negatives, simhash, substring, topk, toxicity, warc


def queries() -> dict:
    return {
        "op1_decontamination": decontaminate.op1_decontamination,
        "op2_warc": warc.op2_warc,
        "op3_language_id": langid.op3_language_id,
        "op4_mixing": mixing.op4_mixing,
        "op5_topk_search": topk.op5_topk_search,
        "op6_toxicity": toxicity.op6_toxicity,
        "op7_chat_formatting": chat.op7_chat_formatting,
        "op8_substring_dedup": substring.op8_substring_dedup,
        "op9_minhash_near_dedup": neardup.op9_minhash_near_dedup,
        "op10_html_extraction": extract_html.op10_html_extraction,
        "op11_hard_negatives": negatives.op11_hard_negatives,
        "op12_source_divergence": divergence.op12_source_divergence,
        "op13_simhash_near_dedup": simhash.op13_simhash_near_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_decontamination": decontaminate.SQL,
        "op2_warc": warc.SQL,
        "op5_topk_search": topk.SQL,
        "op8_substring_dedup": substring.SQL,
        "op11_hard_negatives": negatives.SQL,
        "op12_source_divergence": divergence.SQL,
    }
