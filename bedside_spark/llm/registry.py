"""Registered queries of the subpackage and their DuckDB texts."""

from __future__ import annotations

from bedside_spark.llm.collocations import op11_phrase_collocations
from bedside_spark.llm.convnet import op9_quality_classifier
from bedside_spark.llm.leaks import op5_benchmark_decontamination
from bedside_spark.llm.licences import op1_license_scan
from bedside_spark.llm.pieces import op3_sentencepiece
from bedside_spark.llm import quality
from bedside_spark.llm.quality import op4_quality_rules
from bedside_spark.llm.sequences import op13_arrow_sequences
from bedside_spark.llm.shards import op6_sharding
from bedside_spark.llm.simhash import op10_simhash_near_dedup
from bedside_spark.llm.spellings import op12_spelling_variants
from bedside_spark.llm.substrings import op8_substring_dedup
from bedside_spark.llm.tokencounts import op7_token_counts
from bedside_spark.llm.toxicity import op2_toxicity

QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_toxicity": op2_toxicity,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_quality_rules": op4_quality_rules,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_sharding": op6_sharding,
    "op7_token_counts": op7_token_counts,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_arrow_sequences": op13_arrow_sequences,
}

ORACLE: dict[str, str] = {
    "op4_quality_rules": quality.oracle_sql(),
}
