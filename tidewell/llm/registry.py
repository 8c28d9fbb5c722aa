"""The corpus operators' queries and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from tidewell.llm import decontaminate, html_text, language_id, mixing, near_dedup, periodic_runs, pii, quality_classifier, quality_rules, spelling_variants, substring_dedup, suffix_dedup, url_filters

QUERIES = {
    "op1_quality_classifier": quality_classifier.op1,
    "op2_source_mixing": mixing.op2,
    "op3_url_filters": url_filters.op3,
    "op4_near_dedup": near_dedup.op4,
    "op5_html_text": html_text.op5,
    "op6_language_id": language_id.op6,
    "op7_pii": pii.op7,
    "op8_quality_rules": quality_rules.op8,
    "quality_rule_ablations": quality_rules.ablations,
    "op9_substring_dedup": substring_dedup.op9,
    "op10_decontaminate": decontaminate.op10,
    "op11_suffix_dedup": suffix_dedup.op11,
    "op12_spelling_variants": spelling_variants.op12,
    "op13_periodic_runs": periodic_runs.op13,
}
ORACLES = {
    "op2_source_mixing": mixing.ORACLE,
    "op3_url_filters": url_filters.ORACLE,
    "op4_near_dedup": near_dedup.ORACLE,
    "op7_pii": pii.ORACLE,
    "op8_quality_rules": quality_rules.ORACLE,
    "quality_rule_ablations": quality_rules.ABLATION_ORACLE,
    "op9_substring_dedup": substring_dedup.ORACLE,
    "op10_decontaminate": decontaminate.ORACLE,
    "op11_suffix_dedup": suffix_dedup.ORACLE,
    "op12_spelling_variants": spelling_variants.ORACLE,
    "op13_periodic_runs": periodic_runs.ORACLE,
}
