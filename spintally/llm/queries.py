"""One query for each operator of this subpackage, over a test-data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spintally.llm import (
    decontamination,
    exact_dedup,
    filter_audit,
    jaccard_join,
    licenses,
    mixing,
    periodic_runs,
    quality_classifier,
    quality_rules,
    secrets,
    sharding,
    substring_dedup,
    url_filter,
)

# What the rules judged by, beside the contract's columns.
_THRESHOLDS = ("lang", "source", *(f"most_{name}" for name in quality_rules.LEAST_SPREAD))

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _over_documents(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: report(_table(spark, sf, "documents"))


def benchmark_passages(spark: SparkSession, sf: str) -> DataFrame:
    return decontamination.report(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def url_verdicts(spark: SparkSession, sf: str) -> DataFrame:
    return url_filter.report(_table(spark, sf, "pages"))


def resampled(spark: SparkSession, sf: str) -> DataFrame:
    return quality_classifier.report(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def audited(spark: SparkSession, sf: str) -> DataFrame:
    return filter_audit.audit(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def queries() -> dict[str, Query]:
    return {
        "op1_quality_rules": _over_documents(lambda docs: quality_rules.judge(docs).drop(*_THRESHOLDS)),
        "op2_url_filter": url_verdicts,
        "op3_source_mixing": _over_documents(mixing.report),
        "op4_substring_dedup": _over_documents(lambda docs: substring_dedup.report(docs).drop("factors")),
        "op5_benchmark_decontamination": benchmark_passages,
        "op6_secret_scan": _over_documents(secrets.report),
        "op7_sharding": _over_documents(sharding.report),
        "op8_quality_classifier": resampled,
        "op9_jaccard_join": _over_documents(jaccard_join.report),
        "op10_license_scan": _over_documents(licenses.report),
        "op11_filter_audit": audited,
        "op12_periodic_runs": _over_documents(periodic_runs.report),
        "op13_exact_dedup": _over_documents(exact_dedup.judge),
    }
