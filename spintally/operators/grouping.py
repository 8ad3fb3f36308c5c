"""Sums, maxima and several exact distinct counts in one pass, safe under skew.

Grouping twice, once by leg (carded, uncarded) and once for the whole, would
scan the events twice, shuffle each grouping and join the two. Instead every
row is spread over *facets*, one for each column to count. The first grouping
reduces each facet to its distinct members and notes which legs a member was
seen in; the second counts the members. A member seen in both legs counts in
each of them and once in the whole, which is what makes whole-group distinct
counts right. The measures ride on one of the facets, the carrier.

Both groupings combine before they shuffle, and the first shuffles by key *and*
member, so a key with a third of all rows is still spread over the cluster.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spintally.functions.measures import PARTS, fold_parts, net_win
from spintally.operators.rows import PLAYER_TYPE
from spintally.schema import ALL_PLAYERS, CARDED, UNCARDED

FACET = "facet"
MEMBER = "member"
LEG_FLAGS = {CARDED: "in_carded", UNCARDED: "in_uncarded"}


def members(
    rows: DataFrame, keys: tuple[str, ...], counted: tuple[str, ...], carrier: str
) -> DataFrame:
    """One row per key, facet and distinct member, with the legs it was seen in.

    The carrier's rows hold the measures, summed per member. They alone may have
    a NULL member, which counts for nothing and so belongs to no facet.
    """
    carries = F.col(FACET) == carrier
    return (
        rows.unpivot([*keys, PLAYER_TYPE, *PARTS], list(counted), FACET, MEMBER)
        .filter(carries | F.col(MEMBER).isNotNull())
        .withColumns({part: F.when(carries, F.col(part)) for part in PARTS})
        .groupBy(*keys, FACET, MEMBER)
        .agg(
            *(F.bool_or(F.col(PLAYER_TYPE) == leg).alias(flag) for leg, flag in LEG_FLAGS.items()),
            *fold_parts(),
        )
        .withColumn(FACET, F.when(F.col(MEMBER).isNotNull(), F.col(FACET)))
    )


def distinct_count_name(column: str) -> str:
    return f"distinct_{column}"


def fold_members(found: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Members of smaller groups as those of larger ones: a member of several counts once."""
    flags = (F.bool_or(flag).alias(flag) for flag in LEG_FLAGS.values())
    return found.groupBy(*keys, FACET, MEMBER).agg(*flags, *fold_parts())


def distinct_counts(counted: tuple[str, ...]) -> list[Column]:
    """Counts of members by facet, for a grouping of members by key."""
    return [F.count_if(F.col(FACET) == c).alias(distinct_count_name(c)) for c in counted]


def group_whole(
    rows: DataFrame, keys: tuple[str, ...], counted: tuple[str, ...], listed: str
) -> DataFrame:
    """One row per key, with the distinct values of the ``listed`` column as an array.

    The array is as long as the list that the result has to hold. That column is
    the carrier too, so that most rows of the second grouping have a use for both.
    """
    return whole_of(members(rows, keys, counted, carrier=listed), keys, counted, listed)


def whole_of(
    found: DataFrame, keys: tuple[str, ...], counted: tuple[str, ...], listed: str
) -> DataFrame:
    """The same from the members of each key."""
    values = F.when(F.col(FACET) == listed, F.col(MEMBER))
    return (
        found.groupBy(*keys)
        .agg(*fold_parts(), *distinct_counts(counted), F.collect_list(values).alias(listed))
        .withColumn("net_win", net_win())
    )


def group_split(
    rows: DataFrame, keys: tuple[str, ...], counted: tuple[str, ...], carrier: str
) -> DataFrame:
    """One row per key and leg, and one ``All`` row per key.

    The carrier has to decide the leg, as a card number does. The whole's net win
    adds the legs' net wins, so these are kept apart until the end: a leg without
    one is skipped, rather than making the whole unknown.
    """
    return split_of(members(rows, keys, counted, carrier), keys, counted)


def to_legs(found: DataFrame, keys: tuple[str, ...], whole: bool = True) -> DataFrame:
    """Each member once for each leg that it was seen in, and once for the whole if wanted."""
    carried = [*keys, FACET, *PARTS, *LEG_FLAGS.values()]
    tags = {f"to_{flag}": F.when(F.col(flag), leg) for leg, flag in LEG_FLAGS.items()}
    tags |= {"to_whole": F.lit(ALL_PLAYERS)} if whole else {}
    tagged = found.withColumns(tags).unpivot(carried, list(tags), "origin", PLAYER_TYPE)
    return tagged.filter(F.col(PLAYER_TYPE).isNotNull()).drop("origin")


def split_of(found: DataFrame, keys: tuple[str, ...], counted: tuple[str, ...]) -> DataFrame:
    """Legs and ``All`` rows from the members of each key."""
    leg_sums = [
        F.sum(F.when(F.col(flag), F.col(part))).alias(f"{flag}_{part}")
        for flag in LEG_FLAGS.values()
        for part in ("coin_in", "coin_out", "jackpot")
    ]
    carded, uncarded = (net_win(f"{flag}_") for flag in LEG_FLAGS.values())
    return (
        to_legs(found, keys)
        .groupBy(*keys, PLAYER_TYPE)
        .agg(*fold_parts(), *leg_sums, *distinct_counts(counted))
        .withColumn("net_win", F.coalesce(carded + uncarded, carded, uncarded))
    )
