"""A training corpus from raw documents: five stages, each on all that the one before kept.

Stages take and return whole tables, with the columns of ``documents``; the last
adds ``shard`` and ``slot``. A stage's result is written as Parquet and read again as the
next one's documents, so a lost executor never reaches back past a stage. Scratch tables of a stage
are deleted when the next one begins, as its result is written by then.

Cases: tables may be empty, have NULLs in any column, repeated rows, very long texts and more columns, whatever their
names, which all stages pass on (``shard`` and ``slot`` of the documents give way to the last stage's). With an empty benchmark no document is
contaminated.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from spintally.llm import decontamination, jaccard_join, mixing, quality_rules, sharding
from spintally.sources.scratch import discard, noted, scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Scratch tables of the stage before.
_left: list[str] = []


def _stage(function: Stage) -> Stage:
    @wraps(function)
    def staged(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        discard(spark, _left)
        with noted(_left):
            return function(spark, docs, sf_dir)

    return staged


@_stage
def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the fixed rules or lie outside their group's thresholds go."""
    return quality_rules.filter_docs(docs)


@_stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group linked by a Jaccard similarity of 0.8 over five-word shingles."""
    return jaccard_join.one_of_each(docs, width=5, percent=80)


@_stage
def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a window of a benchmark item occurs go."""
    return decontamination.clean_docs(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are left out or repeated until sources have their target shares of all words."""
    return mixing.mix(docs)


@_stage
def deal_into_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row gets its shard and slot in a reproducible shuffle."""
    return sharding.shard_docs(docs)


STAGES = [
    ("quality rules", drop_low_quality),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_passages),
    ("mixing sources", mix_sources),
    ("sharding", deal_into_shards),
]

# The random numbers of the shuffle and the hash order of its rows have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each result is written, and the one before it deleted."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before: list[str] = []
    for name, stage in STAGES:
        found = stage(spark, docs, sf_dir)
        path = scratch_path(spark, name.replace(" ", "_"))
        found.write.parquet(path)
        docs = spark.read.schema(found.schema).parquet(path)
        discard(spark, before)
        before = [path]
    return docs
