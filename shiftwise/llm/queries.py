"""Registered queries of the corpus operators: name -> (spark, sf_dir) -> DataFrame, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shiftwise.llm import (decontaminate, fill_middle, hard_negatives, html_text, license_scan, mixing, ngram_join, packing, quality, secret_scan, sharding,
                           suffix_dedup, vector_search)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_license_classifier": license_scan.query,
        "op2_cost_balanced_packing": packing.query,
        "op3_hilbert_shards": sharding.query,
        "op4_randomness_battery": secret_scan.query,
        "op5_weak_supervision": quality.query,
        "op6_sainte_lague_mix": mixing.query,
        "op7_layout_rendering": html_text.query,
        "op8_suffix_radix_dedup": suffix_dedup.query,
        "op9_collision_counting": vector_search.query,
        "op10_prefix_filter_join": ngram_join.query,
        "op11_wavelet_fill_middle": fill_middle.query,
        "op12_inverted_multi_index": hard_negatives.query,
        "op13_prefix_containment": decontaminate.query,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op11_wavelet_fill_middle": fill_middle.SQL,
        "op12_inverted_multi_index": hard_negatives.SQL,
        "op13_prefix_containment": decontaminate.SQL,
    }
