"""Mixing sources to target weights by Pareto order sampling.

Every source has a target share of all words, at most ``MOST_TIMES`` its own
size; what a source cannot take goes to the others by weight. Within a source a document is due copies in
proportion to the root of its length, as far as ``MOST_TIMES``, so that the words due add up to the
target: of two documents, the one four times as long is due twice the copies. The whole
copies it gets for certain, and the rest is its inclusion probability, each document's own. Documents are ranked by the odds of a
random number over the odds of that probability, and are taken in that order until
the source's open words are filled. The size of the sample is so fixed in words, and each document is in it about as
often as its probability says:
a document that no longer fits is passed over, and ``ROUNDS`` passes fill what
such documents leave open, the last one also with a document that takes more than is open
if the source then ends nearer to its target.

The random number comes from a digest of the seed and the id, so that reruns agree.
A cumulative sum over a source is taken in ranges of the rank at once:
sums by range are added up first, and a task orders one range of one source,
never a whole source. Ranges are equal parts of the rank's logarithm, of which, whatever the probabilities, none gets more than one in
``RANGES`` of a source's documents but by chance.

Cases: rows that agree in id, source and size share a random number and count as
one document of that many times the size, taken or left together. NULL ids are such an
id, and a NULL source is a source of its own, last in the order of sources. A text
without words has size 0 and takes none; it is due the whole copies of its source's mean. Equal ranks are
taken by id and size. A very long text is counted whole; it may exceed what is open by half at most. Empty tables give empty results. Other
columns are not touched.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spintally.llm.text import NOT_SPACES
from spintally.sources.scratch import kept

WEIGHTS = (5, 2, 1)
MOST_TIMES = 3
SEED = "mix-1"
RANGES = 1024
DIGITS = 9
ROUNDS = 4


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(NOT_SPACES)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``source``, ``source_size``, ``target``: one row a source, which one task holds.

    The sources that end at their limit are those of the least limit for their
    weight, so they are a prefix of the order by that ratio: a source is one of
    them if its fair share of what is left after the earlier ones exceeds it.
    """
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), F.col("rank") % len(weights) + 1)
    ranked = ranked.withColumn("weight", weight).withColumn("most", MOST_TIMES * F.col("source_size"))
    every = Window.partitionBy()
    order = Window.orderBy((F.col("most") / F.col("weight")).asc(), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0))
    weights_left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    shared = ranked.withColumn("left", left).withColumn("weights_left", weights_left)
    shared = shared.withColumn("full", F.col("most") * F.col("weights_left") <= F.col("left") * F.col("weight"))
    # The first source below its limit sets the share of all that follow.
    open_share = F.first(
        F.when(~F.col("full"), F.struct("left", "weights_left")), ignorenulls=True
    ).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    shared = shared.withColumn("share", open_share)
    target = F.when(F.col("share").isNull(), F.col("most").cast("double")).otherwise(
        F.col("share.left") * F.col("weight") / F.col("share.weights_left")
    )
    return shared.select("source", "source_size", target.alias("target"))


def _same(*names: str) -> Column:
    return reduce(Column.__and__, [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in names])


def _marked(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumnsRenamed({name: f"_{name}" for name in names})


def _take(plan: DataFrame, last: bool) -> DataFrame:
    """One pass: takes further documents in order of rank while they fit.

    In the last pass a document fits if the source ends nearer to its target with it.
    """
    own = Window.partitionBy("source")
    taken = plan.groupBy("source").agg(F.sum(F.when(F.col("extra"), F.col("words")).otherwise(0)).alias("filled"))
    plan = plan.join(_marked(kept(taken, "filled"), "source"), _same("source")).drop("_source")
    over = F.col("words") / 2 if last else F.lit(0.0)
    fits = ~F.col("extra") & (F.col("words") > 0) & (F.col("words") - over <= F.col("open") - F.col("filled"))
    plan = plan.withColumn("fits", fits)
    cells = plan.filter("fits").groupBy("source", "bucket").agg(F.sum("words").alias("sum"))
    before = F.sum("sum").over(own.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    cells = cells.select("source", "bucket", F.coalesce(before, F.lit(0)).alias("before"))
    cells = _marked(kept(cells, "cells"), "source", "bucket")
    # Only rows that fit are ordered: a source may have none that does.
    joined = plan.filter("fits").join(cells, _same("source", "bucket")).drop("_source", "_bucket")
    ordered = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size")
    within = F.sum("words").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    takes = F.col("before") + within - over <= F.col("open") - F.col("filled")
    joined = joined.withColumn("extra", takes).select(plan.columns)
    return joined.unionByName(plan.filter("not coalesce(fits, false)")).drop("filled", "fits")


def dealt(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: str = SEED) -> DataFrame:
    """One row per id, source and size, with its ``key`` and the ``bucket`` that it falls into."""
    sized = docs.select("doc_id", "source", words_in(F.col("text")).alias("size"))
    sized = kept(sized.groupBy("doc_id", "source", "size").agg(F.count("*").alias("rows")), "sizes")
    sizes = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    due = _marked(kept(targets(kept(sizes, "sources"), weights), "targets"), "source")
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    number = F.conv(F.substring(F.md5(named), 1, 13), 16, 10).cast("bigint")
    random = (number + F.lit(0.5)) / F.lit(2.0**52)
    df = sized.join(due, _same("source")).drop("_source")
    df = df.join(_marked(kept(rates(df), "rates"), "source"), _same("source")).drop("_source")
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    copies = F.when(F.col("size") > 0, _due(F.col("rate"))).otherwise(F.floor(times))
    df = df.withColumn("words", F.col("size") * F.col("rows")).withColumn("due", F.least(copies, F.lit(MOST_TIMES)))
    df = df.withColumn("whole", F.floor("due").cast("bigint")).withColumn("chance", F.col("due") - F.floor("due"))
    key = F.when(F.col("chance") > 0, (random / (1 - random)) / (F.col("chance") / (1 - F.col("chance"))))
    df = df.withColumn("key", key)
    # A logistic random number has a density of a quarter at most.
    by_rank, by_number = F.floor(F.log("key") * (RANGES // 4)), F.floor(random * RANGES)
    df = df.withColumn("bucket", F.coalesce(by_rank, by_number).cast("int")).withColumn("extra", F.lit(False))
    return df.drop("due", "rate")


def _due(rate: Column) -> Column:
    """A document's copies at its source's rate; rounded, so that whole numbers are met."""
    return F.coalesce(F.round(rate * F.sqrt("size"), DIGITS), F.lit(float(MOST_TIMES)))


def rates(sized: DataFrame) -> DataFrame:
    """``source``, ``rate``, ``open``: copies are due at ``rate`` times the root of the size, and ``open`` words by chance.

    Documents beyond ``MOST_TIMES`` are the longest ones: a prefix of the sizes from the longest down. The rate is that of the first size
    that stays below. A task holds the different sizes of a source.
    """
    some = sized.filter("size > 0").groupBy("source", "size").agg(F.sum("rows").alias("n"), F.first("target").alias("target"))
    down = Window.partitionBy("source").orderBy(F.desc("size"))
    words = F.col("size") * F.col("n")
    before = F.coalesce(F.sum(words).over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum(words * F.sqrt("size")).over(down.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    some = some.withColumn("rate", (F.col("target") - MOST_TIMES * before) / rest)
    below = F.col("rate") * F.sqrt("size") <= MOST_TIMES
    first = F.first(F.when(below, F.col("rate")), ignorenulls=True)
    some = some.withColumn("rate", first.over(down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    due = F.least(_due(F.col("rate")), F.lit(MOST_TIMES))
    open_words = F.sum((due - F.floor(due)) * words)
    found = some.groupBy("source").agg(F.first("rate").alias("rate"), open_words.alias("open"))
    return sized.select("source").distinct().join(_marked(found, "source"), _same("source"), "left").select(
        "source", "rate", F.coalesce("open", F.lit(0.0)).alias("open")
    )


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: str = SEED) -> DataFrame:
    """One row per id, source and size: ``rows``, ``copies`` of each, ``source_size``, ``target``."""
    df = dealt(docs, weights, seed)
    for turn in range(1, ROUNDS + 1):
        df = kept(_take(df, turn == ROUNDS), "taken")
    copies = F.col("whole") + F.col("extra").cast("bigint")
    return df.select("doc_id", "source", "size", "rows", "source_size", "target", copies.alias("copies"))


def report(docs: DataFrame) -> DataFrame:
    """Every document with its size, its source's size and target, and the words taken."""
    each = plan(docs).withColumn("_row", F.explode(F.sequence(F.lit(1), F.col("rows"))))
    return each.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies"
    )


def mix(docs: DataFrame) -> DataFrame:
    """The mix: every document as often as it is taken, with all its columns.

    A document without words is due as many copies as its source gives for certain.
    """
    decided = _marked(plan(docs).select("doc_id", "source", "size", "copies"), "doc_id", "source", "size")
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        "doc_id",
        "source",
        words_in(F.col("text")).alias("size"),
    )
    joined = whole.join(decided, _same("doc_id", "source", "size"))
    copies = F.when(F.col("copies") > 0, F.sequence(F.lit(1), F.col("copies").cast("int")))
    return joined.withColumn("_copy", F.explode(copies)).select("doc.*")
