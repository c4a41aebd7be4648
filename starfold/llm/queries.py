"""Queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, fingerprints, jaccard_join, language_mix, lexical_search, packing, pairwise_quality, periodic_runs, pitman_yor, quality_rules, simhash_index, substring_dedup, url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprints": fingerprints.op1_fingerprints,
    "op2_language_mix": language_mix.op2_language_mix,
    "op3_bpe": bpe.op3_bpe,
    "op4_pairwise_quality": pairwise_quality.op4_pairwise_quality,
    "op5_substring_dedup": substring_dedup.op5_substring_dedup,
    "op6_quality_rules": quality_rules.op6_quality_rules,
    "op7_pitman_yor": pitman_yor.op7_pitman_yor,
    "op8_url_filter": url_filter.op8_url_filter,
    "op9_jaccard_join": jaccard_join.op9_jaccard_join,
    "op10_packing": packing.op10_packing,
    "op11_lexical_search": lexical_search.op11_lexical_search,
    "op12_simhash": simhash_index.op12_simhash,
    "op13_periodic_runs": periodic_runs.op13_periodic_runs,
}
ORACLES: dict[str, str] = {
    "op6_quality_rules": quality_rules.oracle(),
    "op8_url_filter": url_filter.ORACLE,
    "op11_lexical_search": lexical_search.ORACLE,
}
