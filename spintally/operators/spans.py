"""Plays in order of time: gaps between them, the time they cover, and spells of activity.

A window over all plays of a key would put a busy key's plays in one task. Plays are therefore first
combined by key and time, then put in order within *slots* of a minute, of which each holds a
bounded number of different times, and only one row a slot is put in order along a whole key.

What came before the plays at hand is one *carried* time a key, such as its last play: it takes its
place among the slots as a slot without plays, so that a slice gives the same as the whole.

Slots are cut in UTC. Buckets of every zone begin on whole quarters of an hour of UTC, so each slot, and each
quarter, lies in one bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLOT = 60_000
QUARTER = 15 * SLOT

Keys = tuple[str, ...]


def slot_of(time: Column, width: int = SLOT) -> Column:
    """Number of the slot that an epoch-ms time lies in, also before 1970."""
    return F.call_function("div", time - F.pmod(time, F.lit(width)), F.lit(width))


def play_slots(plays: DataFrame, keys: Keys, idle_ms: int | None = None) -> DataFrame:
    """One row per key and slot of the plays' times ``at``.

    ``plays``, their ``first`` and ``last`` time, the ``shortest`` and ``longest`` gap between
    them, and with ``idle_ms`` how many ``breaks`` longer than that lie between them.
    """
    times = plays.groupBy(*keys, "at").agg(F.count("*").alias("plays"))
    times = times.withColumn("slot", slot_of(F.col("at")))
    before = F.lag("at").over(Window.partitionBy(*keys, "slot").orderBy("at"))
    # Plays of one time have no gap between them.
    together = F.when(F.col("plays") > 1, F.lit(0).cast("bigint"))
    times = times.withColumns({"gap": F.col("at") - before, "together": together})
    return times.groupBy(*keys, "slot").agg(
        F.sum("plays").alias("plays"),
        F.min("at").alias("first"),
        F.max("at").alias("last"),
        F.min(F.least("gap", "together")).alias("shortest"),
        F.max(F.greatest("gap", "together")).alias("longest"),
        F.count_if(F.col("gap") > (idle_ms if idle_ms is not None else 0)).alias("breaks"),
    )


def with_carried(slots: DataFrame, carried: DataFrame | None, keys: Keys) -> DataFrame:
    """Slots, and a slot without plays for each carried time ``at``."""
    if carried is None:
        return slots
    zero = F.lit(0).cast("bigint")
    rows = carried.select(
        *keys, slot_of(F.col("at")).alias("slot"), zero.alias("plays"), F.col("at").alias("first"), F.col("at").alias("last")
    )
    return slots.unionByName(rows, allowMissingColumns=True)


def chained(slots: DataFrame, keys: Keys) -> DataFrame:
    """Slots with the ``before``, the last time of the slot before it."""
    # Carried times come before any play, also where they share its slot.
    order = Window.partitionBy(*keys).orderBy("slot", F.col("plays") > 0)
    return slots.withColumn("before", F.lag("last").over(order))


def covered(intervals: DataFrame, keys: Keys) -> DataFrame:
    """Time covered by intervals from ``start`` to before ``end``, overlaps counted once, by slot.

    One row per key and slot: ``covered_ms``, ``reach``, the last end of the intervals in it, and ``plays``, how many of
    those that are ``played`` start in it. An interval is cut into as many rows as it has slots.
    """
    start, end = F.col("start"), F.col("end")
    cut = intervals.filter(end > start).withColumn("slot", F.explode(F.sequence(slot_of(start), slot_of(end - 1))))
    inside = cut.select(
        *keys,
        "slot",
        F.greatest(start, F.col("slot") * SLOT).alias("start"),
        F.least(end, (F.col("slot") + 1) * SLOT).alias("stop"),
        "end",
        (F.col("played") & (F.col("slot") == slot_of(start))).cast("bigint").alias("plays"),
    )
    # Of intervals with one start the longest covers all; a slot has at most SLOT starts.
    longest = inside.groupBy(*keys, "slot", "start").agg(
        F.max("stop").alias("stop"), F.max("end").alias("reach"), F.sum("plays").alias("plays")
    )
    earlier = Window.partitionBy(*keys, "slot").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    known = F.coalesce(F.max("stop").over(earlier), F.col("start"))
    new = F.greatest(F.col("stop") - F.greatest("start", known), F.lit(0).cast("bigint"))
    return (
        longest.withColumn("new", new)
        .groupBy(*keys, "slot")
        .agg(F.sum("new").alias("covered_ms"), F.max("reach").alias("reach"), F.sum("plays").alias("plays"))
    )


def spells(chain: DataFrame, keys: Keys, idle_ms: int) -> DataFrame:
    """Spells of plays with no more than ``idle_ms`` between them, from chained slots.

    One row a spell: ``start`` and ``end``, which is ``idle_ms`` after its last play. Spells do not overlap.
    """
    if idle_ms < SLOT:
        raise ValueError(f"a spell's pause must be at least {SLOT} ms")
    order = Window.partitionBy(*keys).orderBy("slot", F.col("plays") > 0)
    number = F.sum(opens(idle_ms).cast("bigint")).over(order)
    runs = chain.withColumn("spell", number).groupBy(*keys, "spell")
    return runs.agg(F.min("first").alias("start"), (F.max("last") + idle_ms).alias("end")).drop("spell")


def opens(idle_ms: int) -> Column:
    """Whether a chained slot begins a spell."""
    return F.col("before").isNull() | (F.col("first") - F.col("before") > idle_ms)


def in_quarters(spans: DataFrame, keys: Keys) -> DataFrame:
    """Spans that do not overlap, cut at quarters of an hour: ``quarter``, ``start``, ``end``."""
    start, end = F.col("start"), F.col("end")
    places = F.sequence(slot_of(start, QUARTER), slot_of(end - 1, QUARTER))
    return spans.withColumn("quarter", F.explode(places)).select(
        *keys,
        "quarter",
        F.greatest(start, F.col("quarter") * QUARTER).alias("start"),
        F.least(end, (F.col("quarter") + 1) * QUARTER).alias("end"),
    )
