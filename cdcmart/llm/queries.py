"""The registered queries of the operators: each applies one operator, with its production parameters, to its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cdcmart.llm import (
    alignment,
    decontamination,
    divergence,
    licenses,
    packing,
    pages,
    pii,
    prefix_trie,
    simhash,
    suffix_dedup,
    token_counts,
    toxicity,
    window_dedup,
)
from cdcmart.llm.common import read
from cdcmart.llm.oracle import ORACLE  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality(spark: SparkSession, sf: str) -> DataFrame:
    rules = divergence.quality_rules(read(spark, sf, "documents"))
    return rules.drop("char_distance", "word_distance")


def op2_pii(spark: SparkSession, sf: str) -> DataFrame:
    return pii.pii_spans(read(spark, sf, "documents"))


def op3_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf, "documents"))


def op4_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(read(spark, sf, "documents"))


def op5_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf, "documents"), read(spark, sf, "labels"))


def op6_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf, "documents"))


def op7_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontamination.decontaminate(read(spark, sf, "documents"), read(spark, sf, "benchmark"))


def op7_proximity(spark: SparkSession, sf: str) -> DataFrame:
    return decontamination.proximity(read(spark, sf, "documents"), read(spark, sf, "benchmark"))


def op8_main_text(spark: SparkSession, sf: str) -> DataFrame:
    return pages.main_text(read(spark, sf, "pages"))


def op9_repeats(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read(spark, sf, "documents"))


def op10_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.license_scan(read(spark, sf, "documents"))


def op11_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.align(read(spark, sf, "documents"))


def op12_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie.prefix_trie(read(spark, sf, "conversations"))


def op13_windows(spark: SparkSession, sf: str) -> DataFrame:
    return window_dedup.remove_repeated_windows(read(spark, sf, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_quality,
        op2_pii,
        op3_simhash,
        op4_packing,
        op5_toxicity,
        op6_token_counts,
        op7_decontamination,
        op7_proximity,
        op8_main_text,
        op9_repeats,
        op10_licenses,
        op11_alignment,
        op12_prefix_trie,
        op13_windows,
    )
}
