"""The registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from riskgraph.llm import (
    brown, decontaminate, jaccard, language, licences, negatives, packing, quality, ranked, secretscan, substrings, tokens, urls,
)

QUERIES = {
    "op1_secrets": secretscan.op1_secrets,
    "op2_tokens": tokens.op2_tokens,
    "op3_substrings": substrings.op3_substrings,
    "op4_quality": quality.op4_quality,
    "op5_packing": packing.op5_packing,
    "op6_urls": urls.op6_urls,
    "op7_language": language.op7_language,
    "op8_jaccard_join": jaccard.op8_jaccard_join,
    "op9_licences": licences.op9_licences,
    "op10_decontaminate": decontaminate.op10_decontaminate,
    "op11_ranked": ranked.op11_ranked,
    "op12_negatives": negatives.op12_negatives,
    "op13_brown": brown.op13_brown,
}

ORACLES = {
    "op1_secrets": secretscan.ORACLE,
    "op4_quality": quality.ORACLE,
    "op8_jaccard_join": jaccard.ORACLE,
    "op9_licences": licences.ORACLE,
    "op10_decontaminate": decontaminate.ORACLE,
    "op11_ranked": ranked.ORACLE,
    "op12_negatives": negatives.ORACLE,
}
