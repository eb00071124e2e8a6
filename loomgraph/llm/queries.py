"""The queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from . import chat_format, decontaminate, jaccard_join, line_dedup, lm_score, quality_rules, sentencepiece_fst, substring_dedup, suffix_dedup, warc_revisit

_MODULES = {
    "op1_decontaminate": decontaminate,
    "op2_chat_format": chat_format,
    "op3_lm_score": lm_score,
    "op4_sentencepiece_fst": sentencepiece_fst,
    "op5_warc_revisit": warc_revisit,
    "op6_substring_dedup": substring_dedup,
    "op7_suffix_dedup": suffix_dedup,
    "op8_jaccard_join": jaccard_join,
    "op9_quality_rules": quality_rules,
    "op10_line_dedup": line_dedup,
}


def queries() -> dict:
    return {name: m.query for name, m in _MODULES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: m.SQL for name, m in _MODULES.items() if getattr(m, "SQL", None)}
