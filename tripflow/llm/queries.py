"""The queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from tripflow.llm import (
    jaccard,
    language,
    licences,
    merkle,
    mixing,
    periodic,
    pieces,
    quality_crf,
    quality_rules,
    substrings,
    top_k,
    toxicity,
    url_filter,
)

QUERIES = {
    "op1_url_filters": url_filter.op1_url_filters,
    "op2_license_scans": licences.op2_license_scans,
    "op3_sentencepiece": pieces.op3_sentencepiece,
    "op4_language_id": language.op4_language_id,
    "op5_exact_top_k": top_k.op5_exact_top_k,
    "op6_ngram_jaccard_join": jaccard.op6_ngram_jaccard_join,
    "op7_quality_classifier": quality_crf.op7_quality_classifier,
    "op8_mix_sources": mixing.op8_mix_sources,
    "op9_quality_rules": quality_rules.op9_quality_rules,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_merkle_manifest": merkle.op11_merkle_manifest,
    "op12_substring_dedup": substrings.op12_substring_dedup,
    "op13_periodic_runs": periodic.op13_periodic_runs,
}

# the others have no SQL twin: they are tested by brute force or held-out accuracy
ORACLE = {
    "op2_license_scans": licences.ORACLE_SQL,
    "op5_exact_top_k": top_k.ORACLE_SQL,
    "op9_quality_rules": quality_rules.ORACLE_SQL,
    "op11_merkle_manifest": merkle.ORACLE_SQL,
    "op12_substring_dedup": substrings.ORACLE_SQL,
}
