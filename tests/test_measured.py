"""Velocity, occupancy, activity and budgets by game against plain loops, whole and in slices."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from spintally.functions.buckets import format_label
from spintally.operators import spans
from spintally.plans import measured as M
from spintally.plans.rollups import FLOOR, GAME
from spintally.plans.targets import Target
from spintally.sources.tenants import read_tenants, union_tenants
from tests.events import DAY, HOUR, NOON, event, rows, table

MINUTE = 60_000
IDLE = 15 * MINUTE
WIDTH = {"hour": HOUR, "day": DAY}


def made(seed: int, n: int = 150, hours: int = 60, floors: int = 3, **changes) -> list[dict]:
    """Plays in bursts, some at the same time, some very long, some without a duration."""
    rng = random.Random(seed)
    events = []
    for _ in range(n):
        at = NOON + rng.randrange(hours) * HOUR + rng.choice([0, 1, 59, 60, 3599, rng.randrange(3600)]) * 1000
        events += [
            event(
                at=at + rng.choice([0, 0, 500, 20_000]) * k,
                card=rng.choice(["P1", "P2", "", None]),
                floorLocation=f"F{rng.randrange(floors)}",
                ess=rng.choice([None, "E"]),
                devInfoGameTheme=rng.choice([None, "B", "A", "Ä"]),
                duration=rng.choice([None, 0, 3, 45, 600, 100_000]),
                maxCashableRisked=rng.choice([None, 5, 70]),
                **changes,
            )
            for k in range(rng.randint(1, 4))
        ]
    return events


def by_floor(events):
    found = defaultdict(list)
    for e in events:
        found[e["floorLocation"]].append(e)
    return found


def plain_occupancy(events, grain):
    width, found = WIDTH[grain], {}
    lasting = [e for e in events if e["duration"]]
    newest = max(e["eventTime"] for e in lasting) // width
    for floor, own in by_floor(lasting).items():
        covered, reach = defaultdict(list), {}
        for e in own:
            start, end = e["eventTime"], e["eventTime"] + 1000 * e["duration"]
            for b in range(start // width, min((end - 1) // width, newest) + 1):
                covered[b].append((max(start, b * width), min(end, (b + 1) * width)))
                reach[b] = max(reach.get(b, 0), end)
        for b, parts in covered.items():
            total, upto = 0, 0
            for start, end in sorted(parts):
                total += max(0, end - max(start, upto))
                upto = max(upto, end)
            found[format_label(b, grain), floor] = (total, 100.0 * total / width, reach[b])
    return found


def plain_activity(events, grain):
    width, found = WIDTH[grain], {}
    newest = max(e["eventTime"] for e in events) // width
    for floor, own in by_floor(events).items():
        times = sorted(e["eventTime"] for e in own)
        spells = []
        for at in times:
            if spells and at - spells[-1][-1] <= IDLE:
                spells[-1].append(at)
            else:
                spells.append([at])
        for spell in spells:
            start, end = spell[0], spell[-1] + IDLE
            for b in range(start // width, min((end - 1) // width, newest) + 1):
                row = found.setdefault((format_label(b, grain), floor), [0, 0, 0, 0.0, False, None])
                row[2] += min(end, (b + 1) * width) - max(start, b * width)
                row[4] |= end >= (b + 1) * width
            found[format_label(start // width, grain), floor][1] += 1
            for at in spell:
                row = found[format_label(at // width, grain), floor]
                row[0] += 1
                row[5] = max(row[5] or 0, at)
    return {key: (*row[:3], 100.0 * row[2] / width, *row[4:]) for key, row in found.items()}


def plain_velocity(events, grain, key):
    groups, found = defaultdict(list), defaultdict(list)
    for e in events:
        groups[key(e)].append(e["eventTime"])
    for own, times in groups.items():
        times.sort()
        for before, at in zip([None, *times], times):
            found[format_label(at // WIDTH[grain], grain), *own].append((at, None if before is None else at - before))
    done = {}
    for k, plays in found.items():
        gaps = [gap for _, gap in plays if gap is not None]
        mean = sum(gaps) / len(gaps) if gaps else None
        low, high = min(gaps, default=None), max(gaps, default=None)
        done[k] = (len(plays), len(gaps), sum(gaps), mean, low, high, max(at for at, _ in plays))
    return done


def keyed(df, n: int) -> dict:
    found = df.collect()
    assert len({tuple(r)[:n] for r in found}) == len(found)
    return {tuple(r)[:n]: tuple(r)[n:] for r in found}


@pytest.mark.parametrize("grain", ["hour", "day"])
def test_occupancy(spark, grain):
    events = made(1)
    assert keyed(M.measure(table(spark, events), M.FLOOR_OCCUPANCY, grain), 2) == plain_occupancy(events, grain)


@pytest.mark.parametrize("grain", ["hour", "day"])
def test_activity(spark, grain):
    events = made(2)
    assert keyed(M.measure(table(spark, events), M.FLOOR_ACTIVITY, grain), 2) == plain_activity(events, grain)


@pytest.mark.parametrize("grain", ["hour", "day"])
def test_velocity(spark, grain):
    events = made(3)
    carded = [e for e in events if e["playerCardNumber"]]
    found = keyed(M.measure(table(spark, events), M.PLAYER_VELOCITY, grain), 2)
    assert found == plain_velocity(carded, grain, lambda e: (e["playerCardNumber"],))
    found = keyed(M.measure(table(spark, events), M.GAME_VELOCITY, grain), 5)
    game = lambda e: (e["assetNumber"], e["ess"], e["gameId"], e["devInfoGameTheme"])
    assert found == plain_velocity(events, grain, game)


def test_times_before_1970(spark):
    events = [event(at=t, duration=2) for t in (-HOUR - 1500, -500, 10)]
    found = keyed(M.measure(table(spark, events), M.FLOOR_OCCUPANCY, "hour"), 2)
    assert [row[0] for _, row in sorted(found.items())] == [1500, 1000, 2010]
    found = keyed(M.measure(table(spark, events), M.velocity_of(FLOOR), "hour"), 2)
    assert [row[2] for _, row in sorted(found.items())] == [0, HOUR + 1000, 510]


def test_budgets(spark):
    events = made(4)
    wanted = defaultdict(dict)
    for e in events:
        game, budget = e["devInfoGameTheme"], e["maxCashableRisked"]
        if e["playerCardNumber"] and game is not None and budget is not None:
            own = wanted[format_label(e["eventTime"] // DAY, "day"), e["playerCardNumber"]]
            own[game] = max(budget, own.get(game, budget))
    found = keyed(M.measure(table(spark, events), M.PLAYER_BUDGETS, "day"), 2)
    assert found == {
        key: (len(own), max(own.values()), ", ".join(f"{g}={own[g]}" for g in sorted(own, key=str.encode)))
        for key, own in wanted.items()
    }


MODELS = {
    "velocity": M.velocity_of(FLOOR),
    "occupancy": M.FLOOR_OCCUPANCY,
    "activity": M.FLOOR_ACTIVITY,
    "game velocity": M.velocity_of(GAME),
    "budgets": M.PLAYER_BUDGETS,
}


@pytest.mark.parametrize(("grain", "day_folders"), [("hour", True), ("hour", False), ("day", True)])
@pytest.mark.parametrize("name", MODELS)
def test_slices_equal_the_whole(spark, tmp_path, name, grain, day_folders):
    """Cuts fall into plays and spells under way; a slice reads no event before its first bucket."""
    model = MODELS[name]
    events = made(5, n=80)
    target = Target(f"{tmp_path}/t", model, grain, day_folders=day_folders)
    first = None
    for upto in (NOON + 7 * HOUR + 90_000, NOON + 31 * HOUR, NOON + 70 * HOUR):
        if target.newest(spark):
            first = target.newest(spark)[None]
        own = [e for e in events if e["eventTime"] < upto]
        settled = [e for e in own if first is None or format_label(e["eventTime"] // WIDTH[grain], grain) >= first]
        M.refresh_measured(table(spark, settled), target)
        assert rows(target.read(spark)) == rows(M.measure(table(spark, own), model, grain))
    M.refresh_measured(table(spark, events), target, lookback=3)
    assert rows(target.read(spark)) == rows(M.measure(table(spark, events), model, grain))


@pytest.mark.parametrize("name", ["velocity", "occupancy", "activity"])
def test_tenants_start_apart(spark, tmp_path, name):
    model = MODELS[name]
    target = Target(f"{tmp_path}/t", model, "hour", by=("tenant",))
    events = {"fast": made(6, n=60), "slow": made(7, n=60), "new": made(8, n=30)}

    def upto(**hours):
        cut = {n: [e for e in events[n] if e["eventTime"] < NOON + h * HOUR + 1] for n, h in hours.items()}
        return read_tenants(spark, {n: table(spark, own) for n, own in cut.items()})

    M.refresh_measured(upto(fast=40, slow=5), target)
    last = upto(fast=60, slow=60, new=60)
    M.refresh_measured(last, target)
    whole = M.measure(union_tenants(last), model, "hour", by=("tenant",))
    assert rows(target.read(spark)) == rows(whole)


def test_hours_add_up_to_days(spark):
    events = table(spark, made(9))
    for model, column in ((M.FLOOR_OCCUPANCY, "occupied_ms"), (M.velocity_of(FLOOR), "total_gap_ms")):
        day = F.substring("hour_bucket", 1, 10).alias("day")
        hours = M.measure(events, model, "hour").groupBy(day, "floor_location").agg(F.sum(column).alias("ms"))
        days = M.measure(events, model, "day").select(F.substring("day_bucket", 1, 10), "floor_location", column)
        if column == "occupied_ms":  # the newest day goes on after its newest hour
            newest = max(r[0] for r in days.collect())
            hours, days = (df.filter(F.col(df.columns[0]) < newest) for df in (hours, days))
        assert rows(hours) == rows(days)


def test_zones(spark):
    """Hours of a zone half an hour off, over a clock change in another."""
    events = made(10)
    for tz, shift in (("Asia/Kolkata", 5 * HOUR + HOUR // 2), ("Etc/GMT+7", -7 * HOUR)):
        moved = [e | {"eventTime": e["eventTime"] + shift} for e in events]
        for model in (M.FLOOR_OCCUPANCY, M.FLOOR_ACTIVITY, M.velocity_of(FLOOR)):
            stamps = {"busy_until_ms", "last_play_ms"}
            here = M.measure(table(spark, events), model, "day", tz=tz)
            there = M.measure(table(spark, moved), model, "day")
            assert rows(here.drop(*stamps)) == rows(there.drop(*stamps)), (tz, model.name)


def test_other_pauses_and_units(spark):
    events = [event(at=NOON + i * 40 * MINUTE, duration=7) for i in range(3)]
    hour_long = M.activity_of(FLOOR, idle_ms=HOUR)
    found = M.measure(table(spark, events), hour_long, "day").first()
    assert (found.spells_started, found.active_ms) == (1, 80 * MINUTE + HOUR)
    minutes = M.occupancy_of(FLOOR, unit_ms=MINUTE)
    assert M.measure(table(spark, events), minutes, "day").first().occupied_ms == 21 * MINUTE
    with pytest.raises(ValueError, match="pause"):
        M.measure(table(spark, events), M.activity_of(FLOOR, idle_ms=1000), "day")


def test_nothing(spark, tmp_path):
    for i, model in enumerate(MODELS.values()):
        assert M.measure(table(spark, []), model, "hour").collect() == []
        target = Target(f"{tmp_path}/{i}", model, "hour")
        M.refresh_measured(table(spark, []), target)
        M.refresh_measured(table(spark, made(11, n=5)), target)
        assert rows(target.read(spark)) == rows(M.measure(table(spark, made(11, n=5)), model, "hour"))


def test_raw_rows_are_combined_before_any_window(spark, tmp_path):
    """A busy key's plays are grouped by time, combined in each task, before they are put in order."""
    table(spark, made(12, n=5)).write.parquet(f"{tmp_path}/raw")
    plays = M._plays(spark.read.parquet(f"{tmp_path}/raw"), FLOOR, ())
    slots = spans.play_slots(plays, ("floor_location",))
    plan = slots._jdf.queryExecution().executedPlan().toString().split("\n")
    order = [re.search(r"(Window|HashAggregate|Exchange|Scan) ?", line).group(1) for line in plan if re.search(r"(Window|HashAggregate|Exchange|Scan) ?", line)]
    assert order[-4:] == ["HashAggregate", "Exchange", "HashAggregate", "Scan"]
    assert order.index("Window") < len(order) - 4
