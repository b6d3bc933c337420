"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from changeflow.llm import (
    archives,
    exact_dedup,
    filter_audit,
    grid_join,
    jaccard,
    licenses,
    packing,
    pieces,
    quality,
    quality_rules,
    substring_dedup,
    toxicity,
    vector_codes,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_exact_dedup": exact_dedup.op1_exact_dedup,
        "op2_substring_dedup": substring_dedup.op2_substring_dedup,
        "op2_passage_dedup": substring_dedup.op2_passage_dedup,
        "op3_toxicity": toxicity.op3_toxicity,
        "op4_jaccard_join": jaccard.op4_jaccard_join,
        "op5_warc_from_arc": archives.op5_warc_from_arc,
        "op6_license_scan": licenses.op6_license_scan,
        "op6_license_blocks": licenses.op6_license_blocks,
        "op7_best_fit_packing": packing.op7_best_fit_packing,
        "op8_sampled_pieces": pieces.op8_sampled_pieces,
        "op9_quality_classifier": quality.op9_quality_classifier,
        "op10_quality_rules": quality_rules.op10_quality_rules,
        "op11_filter_audit": filter_audit.op11_filter_audit,
        "op12_grid_order_join": grid_join.op12_grid_order_join,
        "op13_vector_codes": vector_codes.op13_vector_codes,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_dedup": exact_dedup.OP1_SQL,
        "op2_substring_dedup": substring_dedup.OP2_SQL,
        "op4_jaccard_join": jaccard.OP4_SQL,
        "op5_warc_from_arc": archives.OP5_SQL,
        "op6_license_scan": licenses.OP6_SQL,
        "op10_quality_rules": quality_rules.OP10_SQL,
        "op11_filter_audit": filter_audit.OP11_SQL,
        "op12_grid_order_join": grid_join.OP12_SQL,
        "op13_vector_codes": vector_codes.OP13_SQL,
    }
