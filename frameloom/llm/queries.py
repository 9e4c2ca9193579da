"""Queries of the operators on training data, by problem."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import read_table
from . import copies, invariants, leaks, mixing, overlaps, pairs, pii, sampling, splits, truncation

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return truncation.found(read_table(spark, sf, "eval_records"), read_table(spark, sf, "documents"))


def p1_report(spark: SparkSession, sf: str) -> DataFrame:
    return truncation.report(read_table(spark, sf, "eval_records"), read_table(spark, sf, "documents"))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return pairs.defects(read_table(spark, sf, "eval_records"), read_table(spark, sf, "documents"))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return splits.parted(spark, read_table(spark, sf, "built_samples"), read_table(spark, sf, "split_targets"))


def p3_assigned(spark: SparkSession, sf: str) -> DataFrame:
    return splits.assign(spark, read_table(spark, sf, "built_samples"), read_table(spark, sf, "split_targets"))


def p3_report(spark: SparkSession, sf: str) -> DataFrame:
    return splits.report(spark, read_table(spark, sf, "built_samples"), read_table(spark, sf, "split_targets"))


def p3_holds(spark: SparkSession, sf: str) -> DataFrame:
    return invariants.splits_hold(spark, read_table(spark, sf, "built_samples"), read_table(spark, sf, "split_targets"))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return overlaps.pairs(read_table(spark, sf, "built_samples"), read_table(spark, sf, "template_records"))


def p4_links(spark: SparkSession, sf: str) -> DataFrame:
    return overlaps.class_links(read_table(spark, sf, "built_samples"), read_table(spark, sf, "template_records"))


def p4_report(spark: SparkSession, sf: str) -> DataFrame:
    return overlaps.report(read_table(spark, sf, "built_samples"), read_table(spark, sf, "template_records"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.unreachable(spark, read_table(spark, sf, "built_samples"), read_table(spark, sf, "sample_targets"))


def p5_sample(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.sample(spark, read_table(spark, sf, "built_samples"), read_table(spark, sf, "sample_targets"))


def p5_report(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.report(spark, read_table(spark, sf, "built_samples"), read_table(spark, sf, "sample_targets"))


def p5_holds(spark: SparkSession, sf: str) -> DataFrame:
    return invariants.sample_holds(spark, read_table(spark, sf, "built_samples"), read_table(spark, sf, "sample_targets"))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return copies.find_copies(read_table(spark, sf, "built_samples"), read_table(spark, sf, "template_records"))


def p6_collapsed(spark: SparkSession, sf: str) -> DataFrame:
    return copies.collapse(read_table(spark, sf, "built_samples"), read_table(spark, sf, "template_records"))


def p7_stable(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.stable(spark, read_table(spark, sf, "built_samples"))


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return leaks.leaks(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark_items"))


def p8_report(spark: SparkSession, sf: str) -> DataFrame:
    return leaks.report(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark_items"))


def p9_mixture(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mixture(spark, read_table(spark, sf, "documents"), read_table(spark, sf, "mix_targets"))


def p9_report(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.report(spark, read_table(spark, sf, "documents"), read_table(spark, sf, "mix_targets"))


def p9_holds(spark: SparkSession, sf: str) -> DataFrame:
    return invariants.mix_holds(spark, read_table(spark, sf, "documents"), read_table(spark, sf, "mix_targets"))


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return pii.found(read_table(spark, sf, "documents"), read_table(spark, sf, "annotators"))


def p10_sanitised(spark: SparkSession, sf: str) -> DataFrame:
    return pii.sanitised(read_table(spark, sf, "documents"), read_table(spark, sf, "annotators"))


def p10_holds(spark: SparkSession, sf: str) -> DataFrame:
    return invariants.text_holds(read_table(spark, sf, "documents"), read_table(spark, sf, "annotators"))


def queries() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name[:1] == "p" and name[1:2].isdigit()}
