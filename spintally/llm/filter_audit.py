"""How filters act upon each other in every order, by counting paths through the lattice of filter sets.

A state is the set of filters already applied, an edge the application of one more, and an order a
path from the empty set to the full one. Documents are first reduced to counts by part and by the
set of filters that they fail, at most 2^k rows a part. Each edge's removals follow from these
counts, whatever order led to it, so 80 edges tell all of 120 orders of five filters.

Forward counting gives the orders that reach each state, backward counting those that
lead on from it, and their product over an edge is the number of orders that take
it. Edge removals weighted by that number and added up are a filter's Shapley sum: its
removals over all orders. The steps of each order are read from the same edges.

The filter for repeated texts needs no join back to the documents: all rows of a text fail the same other
filters, so it is enough to know, for each text, part and label, how many rows there are and how many have
the text's smallest id. Texts are told apart by their SHA-256. Rows are combined before every shuffle, so a text, a
source or an id that a third of the rows share makes no task larger.

Cases: a NULL text is empty, a NULL source is the part with the empty name. A row of NULL id repeats no other and no
other repeats it; rows of the smallest id all pass. Without a label a document is neither good nor toxic; of
several labels any counts. Very long texts are read whole. An empty table has no parts, so the
result is empty. Other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spintally.llm.text import UPPER, spaced_words
from spintally.sources.scratch import kept

MIN_WORDS = 200
MIN_DISTINCT = 50  # per cent of the words
MAX_CAPITALS = 2  # per cent of the characters
SYMBOLS = "[#$%&*|]"

REPEATED = "E"
MEASURES = ("n", "good", "toxic")


def text_filters() -> dict[str, Column]:
    """When a text fails, by the filter's letter."""
    text = F.coalesce("text", F.lit(""))
    words = spaced_words(F.col("text"))
    capitals = F.length(text) - F.length(F.translate(text, UPPER, ""))
    return {
        "A": F.size(words) < MIN_WORDS,
        "B": 100 * F.size(F.array_distinct(words)).cast("bigint") < MIN_DISTINCT * F.size(words).cast("bigint"),
        "C": 100 * capitals.cast("bigint") > MAX_CAPITALS * F.length(text).cast("bigint"),
        "D": text.rlike(SYMBOLS),
    }


def failed_sets(docs: DataFrame, labels: DataFrame, filters: Mapping[str, Column]) -> DataFrame:
    """``part``, ``mask`` (a bit for each filter that is failed, the last for a repeated text), ``n``, ``good``, ``toxic``."""
    repeated = 1 << len(filters)
    mask = sum((failed.cast("int") * (1 << bit) for bit, failed in enumerate(filters.values())), F.lit(0))
    rows = docs.select(
        "doc_id",
        F.coalesce("source", F.lit("")).alias("part"),
        F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest"),
        mask.alias("mask"),
    )
    # Written, so that texts are read once and the join reads plain exchanges.
    rows = kept(rows.groupBy("doc_id", "part", "digest", "mask").agg(F.count("*").alias("n")), "failures")
    known = labels.filter("doc_id is not null").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    named = rows.filter("doc_id is not null").join(known, "doc_id", "left").fillna(0, ["good", "toxic"])
    unnamed = rows.filter("doc_id is null").withColumns({"good": F.lit(0), "toxic": F.lit(0)})
    groups = named.unionByName(unnamed).groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"),
        F.min("doc_id").alias("first"),
        F.min_by("n", "doc_id").alias("n_first"),
    )
    # A text has at most four rows a part here.
    least = F.min("first").over(Window.partitionBy("digest"))
    passing = F.col("unnamed") + F.when(F.col("first") == F.col("least"), F.col("n_first")).otherwise(0)
    groups = groups.withColumn("least", least).withColumn("passing", passing)
    both = F.array(
        F.struct("mask", F.col("passing").alias("n")),
        F.struct((F.col("mask") + repeated).alias("mask"), (F.col("n") - F.col("passing")).alias("n")),
    )
    each = groups.select("part", "good", "toxic", F.explode(both).alias("one")).filter("one.n > 0")
    return each.groupBy("part", F.col("one.mask").alias("mask")).agg(
        F.sum("one.n").alias("n"),
        F.sum(F.col("one.n") * F.col("good")).alias("good"),
        F.sum(F.col("one.n") * F.col("toxic")).alias("toxic"),
    )


def path_counts(k: int) -> dict[tuple[int, int], int]:
    """How many of the orders of ``k`` filters take each edge ``(state, filter)`` of their lattice."""
    full = 2**k - 1
    edges = [(state, one) for state in range(full + 1) for one in range(k) if not state >> one & 1]
    reaching, leaving = [1] + [0] * full, [0] * full + [1]
    # A state's number is less than that of any state with one filter more.
    for state, one in edges:
        reaching[state | 1 << one] += reaching[state]
    for state, one in reversed(edges):
        leaving[state] += leaving[state | 1 << one]
    return {(state, one): reaching[state] * leaving[state | 1 << one] for state, one in edges}


def edge_counts(sets: DataFrame, k: int) -> DataFrame:
    """Per part and edge what its filter keeps, removes and finds removed, and the filter's ``shapley`` sum."""
    edges = [
        F.struct(*(F.lit(v).alias(c) for c, v in zip(("state", "filter", "orders"), (*edge, orders))))
        for edge, orders in path_counts(k).items()
    ]
    rows = sets.select("*", F.explode(F.array(*edges)).alias("edge")).select(*sets.columns, "edge.*")
    bit = F.call_function("shiftleft", F.lit(1), F.col("filter"))
    fails = F.col("mask").bitwiseAND(bit) != 0
    gone = F.col("mask").bitwiseAND(F.col("state")) != 0

    def total(condition: Column, measure: str = "n") -> Column:
        return F.sum(F.when(condition, F.col(measure)).otherwise(0))

    counts = rows.groupBy("part", "state", "filter", "orders").agg(
        total(~fails & ~gone).alias("kept"),
        total(fails & ~gone).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(F.col("mask") == bit).alias("unique_fails"),
        total(fails & ~gone, "good").alias("good_lost"),
        total(fails & ~gone, "toxic").alias("toxic_lost"),
    )
    weighted = F.sum(F.col("removed") * F.col("orders")).over(Window.partitionBy("part", "filter"))
    return counts.withColumn("shapley", weighted).drop("orders")


def every_order(sets: DataFrame, names: Sequence[str]) -> DataFrame:
    """A row a part, order of the filters and step, read from the edges of the lattice.

    The table of steps has k * k! rows for k filters, and is broadcast.
    """
    steps = [
        ("".join(names[f] for f in order), at + 1, sum(1 << f for f in order[:at]), order[at])
        for order in permutations(range(len(names)))
        for at in range(len(names))
    ]
    table = sets.sparkSession.createDataFrame(steps, "filter_order string, step int, state int, filter int")
    found = edge_counts(sets, len(names)).join(F.broadcast(table), ["state", "filter"])
    counts = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return found.select("part", "filter_order", "step", *counts)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every order of the five filters, by source."""
    filters = text_filters()
    sets = kept(failed_sets(docs, labels, filters), "failed_sets")
    return every_order(sets, [*filters, REPEATED])
