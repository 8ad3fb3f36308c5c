"""Daily rollups worked out from hourly states instead of raw events.

Hourly rows cannot be added up to days where they count distinct members: a session that spans two
hours counts once in the day. What adds up is the *state* behind them, the members of each hour and key
with the sums of their plays, as :func:`spintally.operators.grouping.members` gives it. Stored by hour and folded by
day, a member of several hours becomes one, so every daily measure is exact.

A state target is refreshed like any hourly rollup, from its newest hour on. The days from the daily target's
newest day on are then worked out from the stored states of those days; raw events of settled hours are not read
again. States are at most one row per hour, key, facet and member, so they pay where sessions have several plays an hour.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spintally.functions.buckets import UTC, bucket_label
from spintally.functions.measures import PARTS
from spintally.operators.grouping import FACET, LEG_FLAGS, MEMBER, fold_members, members, split_of, whole_of
from spintally.operators.rows import BUCKET, event_rows
from spintally.plans.refresh import Events, Starts, find_starts, session_of, slice_of, swap, whole
from spintally.plans.rollups import CARDS, MODELS, THEMES, Model, complete_totals, finish
from spintally.plans.targets import DAY_FOLDER, Target
from spintally.schema import HOUR_BUCKET, bucket_column
from spintally.sources.tenants import TENANT


@dataclass(frozen=True)
class State(Model):
    """The hourly members of a rollup's keys."""

    def columns(self, grain: str, by: tuple[str, ...] = ()) -> tuple[str, ...]:
        return (*by, bucket_column(grain), *self.keys, FACET, MEMBER, *LEG_FLAGS.values(), *PARTS)

    @property
    def carrier(self) -> str:
        return CARDS if self.split else THEMES


ABSENT = "absent"
STATES = {name: State(m.name, m.keys, m.keep, m.split, m.source) for name, m in MODELS.items()}


def state_target(location: str, model: Model, by: tuple[str, ...] = ()) -> Target:
    """Where the hourly states of a model are kept, in a folder a day."""
    return Target(location, STATES[model.name], "hour", by)


def hour_states(events: DataFrame, state: State, by: tuple[str, ...] = (), tz: str = UTC) -> DataFrame:
    """The states of all events."""
    rows = event_rows(events, "hour", tz, by).filter(state.keep())
    found = members(rows, (*by, BUCKET, *state.keys), state.counted, state.carrier)
    label = bucket_label(F.col(BUCKET), "hour").alias(HOUR_BUCKET)
    return found.select("*", label).select(*state.columns("hour", by))


def days_of(
    states: DataFrame,
    state: State,
    by: tuple[str, ...] = (),
    null_safe_totals: bool = True,
    typed: DataFrame | None = None,
) -> DataFrame:
    """The daily rollup from stored hourly states.

    ``typed`` are event rows whose types of money the result follows; decimals need them, as sums widen these.
    """
    keys = (*by, BUCKET, *state.keys)
    day = F.unix_date(F.to_date(F.substring(HOUR_BUCKET, 1, 10))).cast("bigint")
    found = fold_members(states.withColumn(BUCKET, day), keys)
    if state.split:
        groups = complete_totals(split_of(found, keys, state.counted), keys, null_safe_totals)
    else:
        groups = whole_of(found, keys, state.counted, THEMES)
    return finish(groups, MODELS[state.name], "day", by, states if typed is None else typed)


def refresh_states(
    events: Events, target: Target, *, since: str | None = None, lookback: int = 0, tz: str = UTC
) -> Starts:
    """Works out the newest stored hour's states and all later ones."""
    seen = target.look(session_of(events))
    starts = find_starts(events, target, lookback, since, seen)
    swap(hour_states(slice_of(events, starts, "hour", tz), target.model, target.by, tz), seen, starts)
    return starts


def refresh_days(
    events: Events,
    states: Target,
    days: Target,
    *,
    lookback: int = 0,
    tz: str = UTC,
    null_safe_totals: bool = True,
) -> Starts:
    """Brings the states up to date from the events, and the daily rollup from the states.

    The days that the states' refresh touched are worked out again, and those from the newest stored day on; the
    folders of other days are not opened. ``lookback`` counts hours.
    """
    touched = refresh_states(events, states, lookback=lookback, tz=tz)
    spark = session_of(events)
    seen = days.look(spark)
    starts = {
        name: None if None in (label, touched[name]) else min(label, f"{touched[name][:10]} 00:00:00")
        for name, label in find_starts(events, days, 0, None, seen).items()
    }
    held = states.look(spark)
    chosen = []
    for one in held.partitions:
        start = starts.get(one.get(TENANT), ABSENT)
        if start is None or start is not ABSENT and one[DAY_FOLDER] >= start[:10]:
            chosen.append(one)
    stored = held.rows(chosen)
    if stored is not None:
        typed = event_rows(whole(events), "hour", tz, days.by)
        rolled = days_of(stored.select(*states.columns), states.model, days.by, null_safe_totals, typed)
        swap(rolled, seen, starts)
    return starts

