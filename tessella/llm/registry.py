"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tessella.llm import decontamination, exact_topk, filter_audit, hard_negatives, html_extract, line_dedup, quality, simhash_dedup, source_mix, substring_dedup, suffix_dedup, url_filter, winnowing


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_url_filter": url_filter.op1_url_filter,
        "op3_html_extract": html_extract.op3_html_extract,
        "op2_line_dedup": line_dedup.op2_line_dedup,
        "op4_benchmark_decontamination": decontamination.op4_benchmark_decontamination,
        "op5_exact_topk": exact_topk.op5_exact_topk,
        "op6_substring_dedup": substring_dedup.op6_substring_dedup,
        "op7_quality_classifier": quality.op7_quality_classifier,
        "op8_suffix_array_dedup": suffix_dedup.op8_suffix_array_dedup,
        "op9_simhash_near_dedup": simhash_dedup.op9_simhash_near_dedup,
        "op10_source_mix": source_mix.op10_source_mix,
        "op11_fingerprints": winnowing.op11_fingerprints,
        "op12_filter_audit": filter_audit.op12_filter_audit,
        "op13_hard_negatives": hard_negatives.op13_hard_negatives,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_exact_topk": exact_topk.SQL,
        "op10_source_mix": source_mix.SQL,
        "op11_fingerprints": winnowing.SQL,
        "op12_filter_audit": filter_audit.SQL,
        "op13_hard_negatives": hard_negatives.SQL,
    }
