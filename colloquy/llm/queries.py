"""The corpus operators' queries and their SQL."""

from __future__ import annotations

from . import boosting, bpe, flac, html, jaccard, langid, maxent, mixing, pii, rules

_QUERIES = {
    "op1_pii": pii.op1_pii,
    "op2_html_extraction": html.op2_html_extraction,
    "op3_quality_rules": rules.op3_quality_rules,
    "op4_maxent_scoring": maxent.op4_maxent_scoring,
    "op5_quality_trees": boosting.op5_quality_trees,
    "op6_language_id": langid.op6_language_id,
    "op7_pfair_mixing": mixing.op7_pfair_mixing,
    "op8_flac": flac.op8_flac,
    "op9_jaccard_join": jaccard.op9_jaccard_join,
    "op10_bpe": bpe.op10_bpe,
}
_ORACLES: dict[str, str] = {}


def queries() -> dict:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
