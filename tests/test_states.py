"""Days from hourly states."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import types as T

from spintally.functions.buckets import format_label
from spintally.plans import rollups as R
from spintally.plans.refresh import default_targets, refresh, refresh_all
from spintally.plans.states import days_of, hour_states, refresh_days, state_target
from spintally.plans.targets import Target
from spintally.schema import MONEY_COLUMNS
from spintally.sources.tenants import read_tenants, union_tenants
from tests.events import HOUR, NOON, event, rows, table


def plays(hours: int, floor: str = "0101") -> list[dict]:
    """Sessions that span hours and days, in both legs; NULL members, keys and measures."""
    return [
        event(
            at=NOON + h * HOUR + i * 60_000,
            card=["P1", "P2", "", None][(h + i) % 4],
            sessionUuid=[f"S{h // 5}", None][i == 2],
            devInfoGameTheme=["A", "B", None][h % 3],
            ess=[None, "E"][h % 2],
            updateWon=[None, 30][h % 7 > 0],
            floorLocation=floor,
        )
        for h in range(hours)
        for i in range(3)
    ]


@pytest.mark.parametrize("model", R.MODELS.values(), ids=R.MODELS)
def test_days_equal_those_from_events(spark, tmp_path, model):
    events = plays(60)
    states, days = state_target(f"{tmp_path}/s", model), Target(f"{tmp_path}/d", model, "day")
    for upto in (5, 31, 60):
        # Settled hours are gone from the source, but for the newest stored one.
        first = states.newest(spark).get(None, "")
        own = [e for e in events[: 3 * upto] if format_label(e["eventTime"] // HOUR, "hour") >= first]
        refresh_days(table(spark, own), states, days)
        wanted = R.rollup(table(spark, events[: 3 * upto]), model, "day")
        assert rows(days.read(spark)) == rows(wanted)
        assert days.read(spark).dtypes == wanted.dtypes
    refresh_days(table(spark, events), states, days, lookback=20)
    assert rows(days.read(spark)) == rows(R.rollup(table(spark, events), model, "day"))


def test_literal_totals_and_zones(spark):
    events = table(spark, plays(50))
    state = state_target("x", R.GAME).model
    states = hour_states(events, state, tz="America/New_York")
    for safe in (True, False):
        wanted = R.game_by_day(events, tz="America/New_York", null_safe_totals=safe)
        assert rows(days_of(states, state, null_safe_totals=safe)) == rows(wanted)


def test_tenants(spark, tmp_path):
    by = ("tenant",)
    states, days = state_target(f"{tmp_path}/s", R.FLOOR, by), Target(f"{tmp_path}/d", R.FLOOR, "day", by)
    early = read_tenants(spark, {"a": table(spark, plays(30, "a")), "b": table(spark, plays(4, "b"))})
    refresh_days(early, states, days)
    late = read_tenants(spark, {n: table(spark, plays(55, n)) for n in ("a", "b", "c")})
    refresh_days({"b": late["b"]}, states, days)
    refresh_days(late, states, days)
    wanted = R.rollup(union_tenants(late), R.FLOOR, "day", by=by)
    assert rows(days.read(spark)) == rows(wanted)


def test_decimals_have_one_type_however_they_were_worked_out(spark, tmp_path):
    money = T.DecimalType(18, 2)
    events = table(spark, [event(at=NOON + h * HOUR, **dict.fromkeys(MONEY_COLUMNS, Decimal("1.25"))) for h in range(30)], money)
    targets = default_targets(f"{tmp_path}/all")
    refresh_all(events, targets)
    for name, target in targets.items():
        refresh(events, target)
        wanted = R.rollup(events, target.model, target.grain)
        assert target.read(spark).dtypes == wanted.dtypes, name
        assert rows(target.read(spark)) == rows(wanted), name
    states, days = state_target(f"{tmp_path}/s", R.FLOOR), targets["floor_by_day"]
    refresh_days(events, states, days)
    assert rows(days.read(spark)) == rows(R.floor_by_day(events))


def test_other_days_are_not_opened(spark, tmp_path):
    states, days = state_target(f"{tmp_path}/s", R.PLAYER), Target(f"{tmp_path}/d", R.PLAYER, "day")
    refresh_days(table(spark, plays(80)), states, days)
    for file in (tmp_path / "s" / "bucket_day=2024-01-02").glob("*.parquet"):
        file.write_bytes(b"not parquet")
    refresh_days(table(spark, plays(90)), states, days)
    assert rows(days.read(spark)) == rows(R.player_by_day(table(spark, plays(90))))
