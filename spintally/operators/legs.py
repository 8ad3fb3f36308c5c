"""The carded, uncarded and whole-group rows as separate steps.

These are the building blocks one at a time: leg aggregates, whole-group
distinct counts, their join and the union. All of them start from one table of
members, as :func:`spintally.operators.grouping.members` makes it, so raw rows are
shuffled once. Rollups use the one-pass form of that module, and the tests hold the two equal.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spintally.functions.measures import fold_parts, net_win
from spintally.operators.grouping import distinct_counts, to_legs
from spintally.operators.rows import PLAYER_TYPE
from spintally.schema import ALL_PLAYERS


def legs(found: DataFrame, keys: tuple[str, ...], counted: tuple[str, ...]) -> DataFrame:
    """One row per key and player type, from the members of each key."""
    return (
        to_legs(found, keys, whole=False)
        .groupBy(*keys, PLAYER_TYPE)
        .agg(*fold_parts(), *distinct_counts(counted))
        .withColumn("net_win", net_win())
    )


def distinct_totals(found: DataFrame, keys: tuple[str, ...], counted: tuple[str, ...]) -> DataFrame:
    """Distinct counts per key over both legs, which leg counts do not add up to."""
    return found.groupBy(*keys).agg(*distinct_counts(counted))


def fold_legs(leg_rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Additive measures of the legs folded into one row per key."""
    return leg_rows.groupBy(*keys).agg(*fold_parts(), F.sum("net_win").alias("net_win"))


def join_totals(
    one_per_key: DataFrame, totals: DataFrame, keys: tuple[str, ...], null_safe: bool = True
) -> DataFrame:
    """Inner join on the keys, of which both sides have a row each; ``null_safe`` lets NULL keys meet.

    Grouping takes NULL keys as equal, so both sides are put below each other and
    grouped, which shuffles each once where a null-safe join may do so again.
    """
    measures = [c for c in one_per_key.columns if c not in keys]
    counts = [c for c in totals.columns if c not in keys]
    both = one_per_key.withColumn("_left", F.lit(True)).unionByName(
        totals.withColumn("_right", F.lit(True)), allowMissingColumns=True
    )
    if not null_safe:
        both = both.filter(reduce(and_, (F.col(k).isNotNull() for k in keys)))
    met = both.groupBy(*keys).agg(
        *(F.any_value(c, True).alias(c) for c in (*measures, *counts, "_left", "_right"))
    )
    return met.filter("_left and _right").drop("_left", "_right")


def all_rows(
    leg_rows: DataFrame, totals: DataFrame, keys: tuple[str, ...], null_safe: bool = True
) -> DataFrame:
    """The ``All`` row of every key."""
    joined = join_totals(fold_legs(leg_rows, keys), totals, keys, null_safe)
    return joined.withColumn(PLAYER_TYPE, F.lit(ALL_PLAYERS))


def with_all_rows(
    found: DataFrame, keys: tuple[str, ...], counted: tuple[str, ...], null_safe: bool = True
) -> DataFrame:
    """Legs and ``All`` rows together, matched by column name."""
    leg_rows = legs(found, keys, counted)
    whole = all_rows(leg_rows, distinct_totals(found, keys, counted), keys, null_safe)
    return leg_rows.unionByName(whole)
