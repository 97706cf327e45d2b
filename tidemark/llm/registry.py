"""Queries of the operators and the pipeline, and their SQL where SQL can express them."""

import corpus_pipeline
from tidemark.llm import (
    decontamination,
    hard_negatives,
    html_extraction,
    lexical_search,
    license_scan,
    lm_scoring,
    mixing,
    ngram_join,
    quality_rules,
    secret_scan,
    sharding,
    substring_dedup,
    url_filters,
)

QUERIES = {
    "op1_sharding": sharding.op1_sharding,
    "op2_secret_scans": secret_scan.op2_secret_scans,
    "op3_lm_scoring": lm_scoring.op3_lm_scoring,
    "op4_quality_rules": quality_rules.op4_quality_rules,
    "op5_url_filters": url_filters.op5_url_filters,
    "op6_mixing": mixing.op6_mixing,
    "op7_ngram_jaccard_join": ngram_join.op7_ngram_jaccard_join,
    "op8_benchmark_decontamination": decontamination.op8_benchmark_decontamination,
    "op9_license_scans": license_scan.op9_license_scans,
    "op10_substring_dedup": substring_dedup.op10_substring_dedup,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_html_extraction": html_extraction.op12_html_extraction,
    "op13_lexical_search": lexical_search.op13_lexical_search,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL = {
    "op1_sharding": sharding.OP1_SQL,
    "op3_lm_scoring": lm_scoring.OP3_SQL,
    "op5_url_filters": url_filters.OP5_SQL,
    "op6_mixing": mixing.OP6_SQL,
    "op8_benchmark_decontamination": decontamination.OP8_SQL,
    "op11_hard_negatives": hard_negatives.OP11_SQL,
    "op13_lexical_search": lexical_search.OP13_SQL,
}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
