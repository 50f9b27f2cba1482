"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from . import decontaminate, exact_dedup, jaccard, licenses, packing, pii, preferences, quality, tokens, urls

QUERIES = {
    "op1_token_counts": tokens.op1_token_counts,
    "op2_url_filters": urls.op2_url_filters,
    "op3_decontamination": decontaminate.op3_decontamination,
    "op4_packing": packing.op4_packing,
    "op5_pii": pii.op5_pii,
    "op6_quality": quality.op6_quality,
    "op7_preferences": preferences.op7_preferences,
    "op8_exact_dedup": exact_dedup.op8_exact_dedup,
    "op9_licenses": licenses.op9_licenses,
    "op10_ngram_jaccard": jaccard.op10_ngram_jaccard,
}
ORACLE_SQL = {
    "op2_url_filters": urls.OP2_SQL,
    "op7_preferences": preferences.OP7_SQL,
    "op8_exact_dedup": exact_dedup.OP8_SQL,
}
