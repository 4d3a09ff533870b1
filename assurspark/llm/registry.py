"""Registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .decontamination import contamination_sql, op6_decontamination
from .language_id import op7_language_id
from .line_dedup import op5_line_dedup
from .lm_scoring import op3_lm_scoring
from .merkle_manifest import manifest_sql, op13_merkle_manifest
from .ngram_join import op1_ngram_join
from .quality_classifier import op4_quality_classifier
from .quality_rules import op8_quality_rules
from .source_mixing import op9_source_mixing
from .spelling_variants import op12_spelling_variants, variants_sql
from .substring_dedup import op11_substring_dedup, repeats_sql
from .suffix_dedup import op10_suffix_dedup
from .token_files import op2_token_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_ngram_join, op2_token_files, op3_lm_scoring, op4_quality_classifier, op5_line_dedup,
        op6_decontamination, op7_language_id, op8_quality_rules, op9_source_mixing, op10_suffix_dedup,
        op11_substring_dedup, op12_spelling_variants, op13_merkle_manifest)
}

ORACLES: dict[str, str] = {
    "op6_decontamination": contamination_sql(),
    "op11_substring_dedup": repeats_sql(),
    "op12_spelling_variants": variants_sql(),
    "op13_merkle_manifest": manifest_sql(),
}
