"""Bringing stored rollups up to date.

A refresh finds the newest stored bucket, works that bucket and every later one
out again from the raw events, and swaps those buckets in the target. Running
the same refresh twice changes nothing.

Events are one DataFrame, or a mapping of tenant name to DataFrame as
:func:`spintally.sources.tenants.read_tenants` returns it. Tenants share a job
and a table keyed by tenant, but each starts from its own newest bucket, so a
lagging one loses nothing. Each start reaches its tenant's scan as a plain
filter, with no join.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping
from concurrent.futures import ThreadPoolExecutor
from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spintally.functions.buckets import UTC, format_label, parse_label
from spintally.operators.rows import BUCKET, compact, event_rows, to_days
from spintally.operators.slices import since_slice
from spintally.plans.rollups import MODELS, roll_rows
from spintally.plans.targets import DAY_FOLDER, Snapshot, Target
from spintally.schema import FLOOR_TABLE
from spintally.sources.scratch import written_once
from spintally.sources.sessions import is_path
from spintally.sources.tenants import TENANT, union_tenants

Events = DataFrame | Mapping[str, DataFrame]
# First bucket to work out again, by tenant; None is all of history. A lone
# DataFrame has the one entry named None.
Starts = dict[str | None, str | None]

MODELS_AT_ONCE = 4


def whole(events: Events) -> DataFrame:
    """All events as one DataFrame."""
    return events if isinstance(events, DataFrame) else union_tenants(events)


def session_of(events: Events) -> SparkSession:
    return (events if isinstance(events, DataFrame) else next(iter(events.values()))).sparkSession


def find_starts(
    events: Events,
    target: Target,
    lookback: int = 0,
    since: str | None = None,
    seen: Snapshot | None = None,
) -> Starts:
    """First bucket to work out again, ``lookback`` buckets before the newest stored one.

    ``since`` stands in for the newest stored bucket. ``seen`` is what the target holds.
    """
    names = [None] if isinstance(events, DataFrame) else list(events)
    if (names == [None]) == (TENANT in target.by):
        raise ValueError(f"events by tenant and a target keyed by {TENANT!r} go together")
    seen = seen or target.look(session_of(events))
    newest = seen.newest() if since is None else dict.fromkeys(names, since)
    grain = target.grain
    starts = {
        name: format_label(parse_label(newest[name], grain, back=lookback), grain)
        if name in newest
        else None
        for name in names
    }
    # A commit that was cut off is done again from where it began; one of the whole target, for all tenants.
    for noted, label in seen.notes.items():
        for name in starts if noted is None else [noted]:
            if starts.get(name) is not None:
                starts[name] = label and min(label, starts[name])
    return starts


def slice_of(events: Events, starts: Starts, grain: str, tz: str) -> DataFrame:
    if isinstance(events, DataFrame):
        return since_slice(events, starts[None], grain, tz)
    return union_tenants({n: since_slice(df, starts[n], grain, tz) for n, df in events.items()})


def rebuild(
    events: Events, target: Target, *, tz: str = UTC, null_safe_totals: bool = True
) -> None:
    """Replace the target with a rollup of all events.

    Given some of the stored tenants only, it replaces their buckets and leaves
    the other tenants' rows as they are.
    """
    rows = event_rows(whole(events), target.grain, tz, target.by)
    rolled = roll_rows(rows, target.model, target.grain, target.by, null_safe_totals)
    target.replace(rolled, None if isinstance(events, DataFrame) else list(events))


def refresh(
    events: Events,
    target: Target,
    *,
    since: str | None = None,
    lookback: int = 0,
    tz: str = UTC,
    null_safe_totals: bool = True,
) -> Starts:
    """Work out the newest stored bucket and all later ones; returns where it started.

    Events that arrive later than that are not seen again unless ``lookback``
    reaches back to them, or ``since`` names an earlier bucket to start from.
    """
    seen = target.look(session_of(events))
    starts = find_starts(events, target, lookback, since, seen)
    rows = event_rows(slice_of(events, starts, target.grain, tz), target.grain, tz, target.by)
    rolled = roll_rows(rows, target.model, target.grain, target.by, null_safe_totals)
    swap(rolled, seen, starts)
    return starts


def swap(rolled: DataFrame, seen: Snapshot, starts: Starts) -> None:
    """Puts the buckets that were worked out again in the place of the stored ones.

    A day folder that also holds hours that were not worked out again is swapped whole, with these
    hours. They are told from the result, which is then read twice, so it is written first.
    """
    target, spark = seen.target, rolled.sparkSession
    seen.check(rolled)
    target._create(rolled)
    touched = _touched(seen, starts) if target.hours_share_folders else []
    if not touched:
        with target.committing(spark, starts):
            target.upsert(rolled)
        return
    with written_once(rolled, "refreshed") as ready:
        rows = with_other_hours(ready, seen, touched)
        with target.committing(spark, starts):
            target.upsert(rows)


def by_tenant(df: DataFrame, values: Mapping[str | None, str | int | None], name: str) -> DataFrame:
    """Each row with its own tenant's value, NULL where there is none.

    Tenants' values are a small table, one row for each that the caller named.
    """
    if not values or None in values:
        return df.withColumn(name, F.lit(values.get(None)))
    kind = "bigint" if any(isinstance(value, int) for value in values.values()) else "string"
    table = df.sparkSession.createDataFrame(list(values.items()), f"{TENANT} string, {name} {kind}")
    return df.join(F.broadcast(table), TENANT, "left")


def _touched(seen: Snapshot, starts: Starts) -> list[dict[str, str | None]]:
    """The stored day folders that a refresh from these starts may swap."""
    days = {name: start[:10] for name, start in starts.items() if start is not None}
    return [one for one in seen.partitions if (day := days.get(one.get(TENANT))) and one[DAY_FOLDER] >= day]


def with_other_hours(rolled: DataFrame, seen: Snapshot, touched: list[dict[str, str | None]]) -> DataFrame:
    """Refreshed hours, and the stored hours that share a day folder with them.

    Hours of that day that were not worked out again are carried over as they are: those
    before the start, and any later one whose events the source no longer has.
    """
    target = seen.target
    refreshed = rolled.select(*target.by, target.bucket).distinct()
    stored = seen.rows(touched).select(*target.columns)
    others = stored.join(refreshed, [*target.by, target.bucket], "left_anti")
    return rolled.unionByName(others.select(*rolled.columns))


def default_targets(root: str, **options) -> dict[str, Target]:
    """The six targets by rollup name, under one folder or in one database."""
    joint = "/" if is_path(root) else "."
    return {
        f"{name}_by_{grain}": Target(f"{root}{joint}{name}_by_{grain}", model, grain, **options)
        for name, model in MODELS.items()
        for grain in ("hour", "day")
    }


def refresh_all(
    session_events: Events,
    targets: Mapping[str, Target],
    floor_events: Events | None = None,
    *,
    rebuilt: Collection[str] = ("game_by_day",),
    lookback: int = 0,
    tz: str = UTC,
    null_safe_totals: bool = True,
) -> dict[str, Starts]:
    """Refresh several rollups from one pass over the raw events.

    The events are folded once to one row per session, machine and hour, as far
    back as the rollup furthest behind needs, and every rollup is worked out from
    that much smaller table. It is kept in the session's checkpoint folder
    meanwhile. Rollups that are replaced in full share a table of all history,
    and the others one that starts at their own newest buckets.

    Floor rollups read ``floor_events`` where they are given. Targets named in
    ``rebuilt`` are replaced in full, the rest from their newest bucket onward.
    """
    plans: dict[str, Starts] = {}
    for from_floor, in_full in product((False, True), repeat=2):
        chosen = {
            name: target
            for name, target in targets.items()
            if from_floor == (floor_events is not None and target.model.source == FLOOR_TABLE)
            and in_full == (name in rebuilt)
        }
        if not chosen:
            continue
        events = floor_events if from_floor else session_events
        everything = dict.fromkeys([None] if isinstance(events, DataFrame) else events)
        seen = {} if in_full else {name: t.look(session_of(events)) for name, t in chosen.items()}
        starts = {
            name: everything if in_full else find_starts(events, target, lookback, seen=seen[name])
            for name, target in chosen.items()
        }
        _refresh_together(events, chosen, seen, starts, tz, null_safe_totals)
        plans |= starts
    return plans


def _earliest(starts: Collection[Starts]) -> Starts:
    """The furthest start back per tenant, over several rollups.

    Labels of both grains are full timestamps, so the least text is the earliest.
    """
    tenants = next(iter(starts))
    return {
        tenant: None if None in labels else min(labels)
        for tenant in tenants
        for labels in [[own[tenant] for own in starts]]
    }


def _from_start(rows: DataFrame, starts: Starts, grain: str) -> DataFrame:
    """Rows at or after their own tenant's start."""
    first = {t: None if label is None else parse_label(label, grain) for t, label in starts.items()}
    if all(label is None for label in first.values()):
        return rows
    known = by_tenant(rows, first, "_start")
    return known.filter(F.col("_start").isNull() | (F.col(BUCKET) >= F.col("_start"))).drop("_start")


def _refresh_together(
    events: Events,
    targets: Mapping[str, Target],
    seen: Mapping[str, Snapshot],
    starts: Mapping[str, Starts],
    tz: str,
    null_safe_totals: bool,
) -> None:
    """Targets that ``seen`` has are refreshed, the others replaced in full."""
    by = next(iter(targets.values())).by
    if any(target.by != by for target in targets.values()):
        raise ValueError("targets refreshed together need the same leading keys")

    def bring_up_to_date(name: str, rows: DataFrame) -> None:
        target = targets[name]
        rolled = roll_rows(rows, target.model, target.grain, by, null_safe_totals, typed=single)
        if name in seen:
            swap(rolled, seen[name], starts[name])
        else:
            target.replace(rolled, None if isinstance(events, DataFrame) else list(events))

    if len(targets) == 1:  # nothing to share
        [(name, target)] = targets.items()
        sliced = slice_of(events, starts[name], target.grain, tz)
        single = event_rows(sliced, target.grain, tz, by)
        bring_up_to_date(name, single)
        return
    sliced = slice_of(events, _earliest(starts.values()), "hour", tz)
    single = event_rows(sliced, "hour", tz, by)
    with written_once(compact(single, by), "session_hours") as hours:

        def wanted(name: str) -> DataFrame:
            grain = targets[name].grain
            return _from_start(hours if grain == "hour" else to_days(hours), starts[name], grain)

        with ThreadPoolExecutor(MODELS_AT_ONCE) as pool:
            for done in [pool.submit(bring_up_to_date, name, wanted(name)) for name in targets]:
                done.result()
