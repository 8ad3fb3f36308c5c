"""Rollups of time and order: bet velocity, occupancy and activity, and budgets by game.

Each is a :class:`Measured` model, refreshed slice by slice like the others. Where a slice depends on
what came before it, the stored rows carry that over: the last play of a key, or the time that its plays last
until, so no event before the slice is read again.

A play lasts from its ``eventTime`` for its ``duration``, which is in seconds unless ``unit_ms`` says otherwise.
Plays without a duration take no time. Parts of a bucket are parts of its width on the clock, so an
hour has 3,600 seconds and a day 86,400, also where clocks change.

Rows go up to the bucket of the newest play (for occupancy, of those that take time). Time that a play or a spell reaches beyond it is counted once later
plays make a later bucket, which keeps the newest stored bucket the one that a refresh has to start from.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spintally.functions.buckets import UTC, bucket_label, bucket_number, earliest_event_time, parse_label
from spintally.operators import spans
from spintally.operators.rows import BUCKET, DIMENSIONS, is_update
from spintally.operators.slices import since_slice
from spintally.plans.refresh import Events, Starts, by_tenant, find_starts, session_of, slice_of, swap
from spintally.plans.rollups import FLOOR, GAME, PLAYER, THEMES, Model
from spintally.plans.targets import Snapshot, Target
from spintally.schema import BUDGET_COLUMN, THEME_SEPARATOR, bucket_column
from spintally.sources.scratch import kept

IDLE_MS = 15 * 60_000
UNIT_MS = 1000
_WIDTH = {"hour": 3_600_000, "day": 86_400_000}


@dataclass(frozen=True)
class Measured(Model):
    """A rollup whose measures ``work`` gives, from events and the carried time of each key.

    ``carried`` names the stored column whose greatest value before a slice is that time.
    """

    listed: tuple[str, ...] = ()
    work: Callable[..., DataFrame] | None = None
    carried: str | None = None

    def columns(self, grain: str, by: tuple[str, ...] = ()) -> tuple[str, ...]:
        return (*by, bucket_column(grain), *self.keys, *self.listed)


def _plays(events: DataFrame, model: Model, by: tuple[str, ...], *more: Column) -> DataFrame:
    """The plays that a model keeps: its keys, their time ``at``, and more columns."""
    keys = (F.col(DIMENSIONS[name]).alias(name) for name in model.keys)
    rows = events.filter(is_update()).select(*by, *keys, F.col("eventTime").alias("at"), *more)
    return rows.filter(model.keep())


def _up_to_newest(rows: DataFrame, slots: DataFrame, by: tuple[str, ...], grain: str, tz: str) -> DataFrame:
    """Rows of buckets up to that of the newest play."""
    newest = slots.filter("plays > 0").groupBy(*by).agg(F.max("slot").alias("newest"))
    newest = newest.withColumn("newest", bucket_number(F.col("newest") * spans.SLOT, grain, tz))
    if not by:
        return rows.filter(F.col(BUCKET) <= F.lit(newest.first().newest))
    return rows.join(newest, list(by)).filter(F.col(BUCKET) <= F.col("newest")).drop("newest")


def _finished(rows: DataFrame, model: Measured, grain: str, by: tuple[str, ...]) -> DataFrame:
    label = bucket_label(F.col(BUCKET), grain).alias(bucket_column(grain))
    return rows.select("*", label).select(*model.columns(grain, by))


def _bucket(number: Column, width: int, grain: str, tz: str) -> Column:
    return bucket_number(number * width, grain, tz).alias(BUCKET)


def _per_cent(ms: Column, grain: str) -> Column:
    return (100 * ms).cast("double") / _WIDTH[grain]


# --- The measures ---------------------------------------------------------------


def velocity(
    events: DataFrame, model: Measured, grain: str, by: tuple[str, ...] = (), tz: str = UTC, carried: DataFrame | None = None
) -> DataFrame:
    """Time between a key's plays: a gap belongs to the bucket of the play that ends it.

    Gaps within a slot add up to its last time less its first, so their mean needs no order.
    """
    keys = (*by, *model.keys)
    slots = spans.play_slots(_plays(events, model, by), keys)
    chain = spans.chained(spans.with_carried(slots, carried, keys), keys).filter("plays > 0")
    gap = F.col("first") - F.col("before")
    rolled = chain.groupBy(_bucket(F.col("slot"), spans.SLOT, grain, tz), *keys).agg(
        F.sum("plays").alias("total_spins"),
        F.sum(F.col("plays") - F.when(gap.isNull(), 1).otherwise(0)).alias("timed_plays"),
        F.sum(F.col("last") - F.col("first") + F.coalesce(gap, F.lit(0))).alias("total_gap_ms"),
        F.min(F.least("shortest", gap)).alias("shortest_gap_ms"),
        F.max(F.greatest("longest", gap)).alias("longest_gap_ms"),
        F.max("last").alias("last_play_ms"),
    )
    mean = F.col("total_gap_ms").cast("double") / F.nullif("timed_plays", F.lit(0))
    return _finished(rolled.withColumn("avg_gap_ms", mean), model, grain, by)


def occupancy(
    events: DataFrame,
    model: Measured,
    grain: str,
    by: tuple[str, ...] = (),
    tz: str = UTC,
    carried: DataFrame | None = None,
    unit_ms: int = UNIT_MS,
) -> DataFrame:
    """How long a key had at least one play under way, and that as a part of the bucket."""
    keys = (*by, *model.keys)
    lasts = (F.coalesce("duration", F.lit(0)) * unit_ms).alias("lasts")
    plays = _plays(events, model, by, lasts).withColumn("played", F.lit(True))
    times = plays.withColumnRenamed("at", "start").withColumn("end", F.col("start") + F.col("lasts")).drop("lasts")
    if carried is not None:
        ends = carried.select(*keys, F.col("since").alias("start"), F.col("at").alias("end"), F.lit(False).alias("played"))
        times = times.unionByName(ends)
    slots = kept(spans.covered(times, keys), "covered")
    rolled = slots.groupBy(_bucket(F.col("slot"), spans.SLOT, grain, tz), *keys).agg(
        F.sum("covered_ms").alias("occupied_ms"), F.max("reach").alias("busy_until_ms")
    )
    rolled = rolled.withColumn("occupancy_pct", _per_cent(F.col("occupied_ms"), grain))
    return _finished(_up_to_newest(rolled, slots, by, grain, tz), model, grain, by)


def activity(
    events: DataFrame,
    model: Measured,
    grain: str,
    by: tuple[str, ...] = (),
    tz: str = UTC,
    carried: DataFrame | None = None,
    idle_ms: int = IDLE_MS,
) -> DataFrame:
    """Spells in which a key is active: from a play until ``idle_ms`` after the last one before a longer pause.

    Spells cross buckets and slices. ``active_at_end`` tells whether one reaches the bucket's end.
    """
    keys = (*by, *model.keys)
    slots = kept(spans.play_slots(_plays(events, model, by), keys, idle_ms), "play_slots")
    chain = spans.chained(spans.with_carried(slots, carried, keys), keys)
    width = {"grain": grain, "tz": tz}
    played = chain.filter("plays > 0").groupBy(_bucket(F.col("slot"), spans.SLOT, **width), *keys).agg(
        F.sum("plays").alias("total_spins"),
        F.sum(F.col("breaks") + spans.opens(idle_ms).cast("bigint")).alias("spells_started"),
        F.max("last").alias("last_play_ms"),
    )
    pieces = spans.in_quarters(spans.spells(chain, keys, idle_ms), keys)
    end = (F.col("quarter") + 1) * spans.QUARTER
    last = bucket_number(end, grain, tz) != bucket_number(end - 1, grain, tz)
    active = pieces.groupBy(_bucket(F.col("quarter"), spans.QUARTER, **width), *keys).agg(
        F.sum(F.col("end") - F.col("start")).alias("active_ms"), F.bool_or(last & (F.col("end") == end)).alias("active_at_end")
    )
    # Both have one row a bucket and key; grouping takes NULL keys as equal.
    rolled = played.unionByName(active, allowMissingColumns=True).groupBy(BUCKET, *keys).agg(
        *(F.max(c).alias(c) for c in ("total_spins", "spells_started", "active_ms", "active_at_end", "last_play_ms"))
    )
    rolled = rolled.fillna(0, ["total_spins", "spells_started"])
    rolled = rolled.withColumn("active_pct", _per_cent(F.col("active_ms"), grain))
    return _finished(_up_to_newest(rolled, slots, by, grain, tz), model, grain, by)


def budgets(
    events: DataFrame, model: Measured, grain: str, by: tuple[str, ...] = (), tz: str = UTC, carried: DataFrame | None = None
) -> DataFrame:
    """Each player's greatest budget by game, as one text in order of the games' names.

    The first grouping, by player and game, spreads a player with very many plays; the second has one row a game.
    Games without a name and plays without a budget are left out.
    """
    keys = (*by, BUCKET, *model.keys)
    plays = _plays(events, model, by, F.col(DIMENSIONS[THEMES]).alias(THEMES), F.col(BUDGET_COLUMN).alias("budget"))
    plays = plays.withColumn(BUCKET, bucket_number(F.col("at"), grain, tz)).filter(F.col(THEMES).isNotNull() & F.col("budget").isNotNull())
    games = plays.groupBy(*keys, THEMES).agg(F.max("budget").alias("budget"))
    rolled = games.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(THEMES, "budget"))).alias("each"),
        F.count("*").cast("bigint").alias("games"),
        F.max("budget").alias("max_player_budget"),
    )
    text = F.transform("each", lambda one: F.concat_ws("=", one[THEMES], one["budget"].cast("string")))
    rolled = rolled.withColumn("max_budget_by_game", F.array_join(text, THEME_SEPARATOR))
    return _finished(rolled, model, grain, by)


_VELOCITY = (
    "total_spins", "timed_plays", "total_gap_ms", "avg_gap_ms", "shortest_gap_ms", "longest_gap_ms", "last_play_ms",
)
_OCCUPANCY = ("occupied_ms", "occupancy_pct", "busy_until_ms")
_ACTIVITY = ("total_spins", "spells_started", "active_ms", "active_pct", "active_at_end", "last_play_ms")
_BUDGETS = ("games", "max_player_budget", "max_budget_by_game")


def _of(model: Model, name: str, listed: tuple[str, ...], work: Callable, carried: str | None = None) -> Measured:
    return Measured(f"{model.name}_{name}", model.keys, model.keep, False, model.source, listed, work, carried)


def velocity_of(model: Model) -> Measured:
    return _of(model, "velocity", _VELOCITY, velocity, "last_play_ms")


def occupancy_of(model: Model, unit_ms: int = UNIT_MS) -> Measured:
    return _of(model, "occupancy", _OCCUPANCY, partial(occupancy, unit_ms=unit_ms), "busy_until_ms")


def activity_of(model: Model, idle_ms: int = IDLE_MS) -> Measured:
    return _of(model, "activity", _ACTIVITY, partial(activity, idle_ms=idle_ms), "last_play_ms")


PLAYER_VELOCITY, GAME_VELOCITY = velocity_of(PLAYER), velocity_of(GAME)
FLOOR_OCCUPANCY = occupancy_of(FLOOR)
FLOOR_ACTIVITY = activity_of(FLOOR)
PLAYER_BUDGETS = _of(PLAYER, "budgets", _BUDGETS, budgets)


# --- In full and in slices --------------------------------------------------------


def measure(
    events: DataFrame, model: Measured, grain: str, *, by: tuple[str, ...] = (), tz: str = UTC
) -> DataFrame:
    """A measured rollup of all events."""
    return model.work(events, model, grain, by=by, tz=tz)


def carried_over(seen: Snapshot, starts: Starts, tz: str) -> DataFrame | None:
    """The carried time ``at`` of each key before its slice, and the slice's first millisecond ``since``."""
    target = seen.target
    stored = seen.rows()
    if target.model.carried is None or stored is None or all(label is None for label in starts.values()):
        return None
    first = {
        name: None if label is None else earliest_event_time(parse_label(label, target.grain), target.grain, tz)
        for name, label in starts.items()
    }
    rows = by_tenant(by_tenant(stored, starts, "_start"), first, "since")
    rows = rows.filter(F.col(target.bucket) < F.col("_start"))
    return rows.groupBy(*target.by, *target.model.keys, "since").agg(F.max(target.model.carried).alias("at"))


def refresh_measured(
    events: Events, target: Target, *, since: str | None = None, lookback: int = 0, tz: str = UTC
) -> Starts:
    """As :func:`spintally.plans.refresh.refresh`, for measured rollups."""
    seen = target.look(session_of(events))
    starts = find_starts(events, target, lookback, since, seen)
    sliced = slice_of(events, starts, target.grain, tz)
    carried = carried_over(seen, starts, tz)
    rolled = target.model.work(sliced, target.model, target.grain, by=target.by, tz=tz, carried=carried)
    # What is carried over may also reach back.
    own = by_tenant(rolled, starts, "_start")
    own = own.filter(F.col("_start").isNull() | (F.col(target.bucket) >= F.col("_start"))).select(*target.columns)
    swap(own, seen, starts)
    return starts
