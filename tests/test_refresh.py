"""Stored rollups: incremental refresh, rebuild, folders, tables and tenants."""

from __future__ import annotations

import time
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spintally.plans import rollups as R
from spintally.plans.refresh import default_targets, rebuild, refresh, refresh_all
from spintally.plans.targets import Target
from spintally.schema import MONEY_COLUMNS
from spintally.sources.scratch import written_once
from spintally.sources.sessions import read_sessions, session_table
from spintally.sources.tenants import matching, read_tenants, union_tenants
from tests.events import DAY, HOUR, NOON, event, rows, table

LAYOUTS = pytest.mark.parametrize(
    ("grain", "day_folders"), [("hour", True), ("hour", False), ("day", True)]
)


def plays(start: int, hours: int, **changes) -> list[dict]:
    """Three plays an hour: carded, another card, and none."""
    return [
        event(at=start + h * HOUR + i * 60_000, card=card, sessionUuid=f"S{h % 4}", **changes)
        for h in range(hours)
        for i, card in enumerate(["P1", "P2", None])
    ]


@LAYOUTS
@pytest.mark.parametrize("model", R.MODELS.values(), ids=R.MODELS)
def test_slices_in_time_order_equal_one_full_run(spark, tmp_path, model, grain, day_folders):
    events = plays(NOON, 40, ess=None)
    target = Target(f"{tmp_path}/t", model, grain, day_folders=day_folders)
    for upto in (NOON + 5 * HOUR + 90_000, NOON + 17 * HOUR, NOON + 60 * HOUR):
        refresh(table(spark, [e for e in events if e["eventTime"] < upto]), target)
    full = R.rollup(table(spark, events), model, grain)
    assert rows(target.read(spark)) == rows(full)
    assert target.read(spark).dtypes == full.dtypes
    # The same refresh again changes nothing, NULL keys included.
    refresh(table(spark, events), target)
    assert rows(target.read(spark)) == rows(full)


@LAYOUTS
def test_late_events_need_lookback_or_since(spark, tmp_path, grain, day_folders):
    width = HOUR if grain == "hour" else DAY
    target = Target(f"{tmp_path}/t", R.FLOOR, grain, day_folders=day_folders)
    old = [event(at=NOON + n * width) for n in range(4)]
    refresh(table(spark, old), target)
    late = table(spark, [*old, event(at=NOON + width, card="P9"), event(at=NOON, card="P9")])
    full = rows(R.rollup(late, R.FLOOR, grain))

    before = rows(target.read(spark))
    refresh(late, target)
    assert rows(target.read(spark)) == before
    refresh(late, target, lookback=2)
    partly = {r[0]: r.total_spins for r in target.read(spark).filter("player_type='All'").collect()}
    assert list(dict(sorted(partly.items())).values()) == [1, 2, 1, 1]
    first = min(partly)
    assert refresh(late, target, since=first) == {None: first}
    assert rows(target.read(spark)) == full


@LAYOUTS
def test_nothing_is_lost_when_the_source_forgets(spark, tmp_path, grain, day_folders):
    target = Target(f"{tmp_path}/t", R.FLOOR, grain, day_folders=day_folders)
    old, new = plays(NOON, 6), plays(NOON + 8 * HOUR, 10)
    refresh(table(spark, old), target)
    refresh(table(spark, new), target)
    if grain == "hour":
        assert rows(target.read(spark)) == rows(R.floor_by_hour(table(spark, [*old, *new])))
    else:
        assert {r.day_bucket for r in target.read(spark).collect()} == {
            "2024-01-01 00:00:00",
            "2024-01-02 00:00:00",
        }


def test_missing_and_empty_targets_mean_first_run(spark, tmp_path):
    target = Target(f"{tmp_path}/t", R.FLOOR, "hour")
    assert target.read(spark) is None
    rebuild(table(spark, []), target)
    assert target.newest(spark) == {}
    assert refresh(table(spark, plays(NOON, 2)), target) == {None: None}
    assert target.newest(spark) == {None: "2024-01-01 13:00:00"}
    assert target.read(spark).count() == 6


def test_rebuild_drops_what_is_no_longer_there(spark, tmp_path):
    target = Target(f"{tmp_path}/t", R.GAME, "day")
    rebuild(table(spark, [event(), event(at=NOON - 5 * DAY)]), target)
    rebuild(table(spark, [event()]), target)
    assert {r.day_bucket for r in target.read(spark).collect()} == {"2024-01-01 00:00:00"}


@LAYOUTS
def test_catalog_table_target(spark, grain, day_folders):
    name = f"floor_{grain}_{day_folders}".lower()
    target = Target(f"default.{name}", R.FLOOR, grain, day_folders=day_folders)
    events = plays(NOON, 30)
    assert target.read(spark) is None
    refresh(table(spark, events[:50]), target)
    refresh(table(spark, events), target)
    full = R.rollup(table(spark, events), R.FLOOR, grain)
    assert rows(target.read(spark)) == rows(full)
    rebuild(table(spark, events[:9]), target)
    assert rows(target.read(spark)) == rows(R.rollup(table(spark, events[:9]), R.FLOOR, grain))


def test_hourly_rollups_share_day_folders(spark, tmp_path):
    rebuild(table(spark, plays(NOON, 20)), Target(f"{tmp_path}/d", R.FLOOR, "hour"))
    assert {p.name for p in Path(f"{tmp_path}/d").glob("*=*")} == {
        "bucket_day=2024-01-01",
        "bucket_day=2024-01-02",
    }
    target = Target(f"{tmp_path}/h", R.FLOOR, "hour", day_folders=False)
    rebuild(table(spark, plays(NOON, 20)), target)
    assert len(list(Path(f"{tmp_path}/h").glob("*=*"))) == 20


def test_decimal_target_reads_back_as_written(spark, tmp_path):
    money = T.DecimalType(18, 2)
    one = dict.fromkeys(MONEY_COLUMNS, Decimal("1.25"))
    target = Target(f"{tmp_path}/t", R.FLOOR, "day", money=money)
    events = table(spark, [event(**one), event(card=None, **one)], money)
    refresh(events, target)
    assert target.read(spark).dtypes == R.floor_by_day(events).dtypes
    assert rows(target.read(spark)) == rows(R.floor_by_day(events))


# --- All six together ----------------------------------------------------------


def test_refresh_all_equals_each_on_its_own(spark, tmp_path):
    folder = spark.conf.get("spark.checkpoint.dir")
    events = plays(NOON, 30)
    other = table(spark, plays(NOON, 33, floorLocation="0199"))
    targets = default_targets(f"{tmp_path}/all")
    refresh_all(table(spark, events[:40]), targets, other)
    starts = refresh_all(table(spark, events), targets, other)
    assert starts["game_by_day"] == {None: None}
    assert starts["game_by_hour"] == {None: "2024-01-02 01:00:00"}
    assert starts["floor_by_hour"] == {None: "2024-01-02 20:00:00"}
    for name, target in targets.items():
        source = other if target.model is R.FLOOR else table(spark, events)
        assert rows(target.read(spark)) == rows(R.rollup(source, target.model, target.grain)), name
    assert not list(Path(folder).glob("session_hours-*"))


def test_refresh_all_can_run_a_subset(spark, tmp_path):
    targets = default_targets(f"{tmp_path}/some")
    refresh_all(table(spark, plays(NOON, 3)), {n: targets[n] for n in ("floor_by_day",)})
    assert targets["floor_by_day"].read(spark).count() == 3
    assert targets["game_by_day"].read(spark) is None


# --- Tenants ---------------------------------------------------------------------


def test_names_match_like_sql():
    names = ["site_a", "SITE_b", "siteXc", "other", "site_"]
    assert matching(names, "site_%") == ["site_a", "SITE_b", "siteXc", "site_"]
    assert matching(names, "site.%") == []


def test_tenants_with_equal_keys_stay_apart(spark):
    frames = read_tenants(
        spark, {"a": table(spark, [event()]), "b": table(spark, [event(), event()])}
    )
    rolled = R.floor_by_day(union_tenants(frames), by=("tenant",))
    spins = {(r.tenant, r.player_type): r.total_spins for r in rolled.collect()}
    assert spins == {("a", "carded"): 1, ("a", "All"): 1, ("b", "carded"): 2, ("b", "All"): 2}
    assert rolled.columns[0] == "tenant"


@LAYOUTS
def test_a_lagging_tenant_loses_nothing(spark, tmp_path, grain, day_folders):
    fast, slow = plays(NOON, 60), plays(NOON, 60, floorLocation="0202")
    target = Target(
        f"{tmp_path}/t", R.FLOOR, grain, by=("tenant",), day_folders=day_folders
    )

    def tenants(**events):
        return read_tenants(spark, {name: table(spark, e) for name, e in events.items()})

    refresh(tenants(fast=fast[:150], slow=slow[:20]), target)
    refresh(tenants(fast=fast, slow=slow, new=fast), target)
    whole = union_tenants(tenants(fast=fast, slow=slow, new=fast))
    assert rows(target.read(spark)) == rows(R.rollup(whole, R.FLOOR, grain, by=("tenant",)))
    # Running one tenant again leaves the others alone.
    refresh(read_tenants(spark, {"slow": table(spark, slow), "fast": ""}, only=["slow"]), target)
    assert rows(target.read(spark)) == rows(R.rollup(whole, R.FLOOR, grain, by=("tenant",)))


def test_refresh_all_with_tenants(spark, tmp_path):
    targets = default_targets(f"{tmp_path}/all", by=("tenant",))
    early = {"a": table(spark, plays(NOON, 30)), "b": table(spark, plays(NOON, 3))}
    later = {n: table(spark, plays(NOON, 40)) for n in ("a", "b", "c")}
    refresh_all(read_tenants(spark, early), targets)
    refresh_all(read_tenants(spark, later), targets)
    whole = union_tenants(read_tenants(spark, later))
    for name, target in targets.items():
        wanted = R.rollup(whole, target.model, target.grain, by=("tenant",))
        assert rows(target.read(spark)) == rows(wanted), name


def test_tenant_events_need_a_tenant_target(spark, tmp_path):
    frames = read_tenants(spark, {"a": table(spark, [event()])})
    with pytest.raises(ValueError, match="tenant"):
        refresh(frames, Target(f"{tmp_path}/t", R.FLOOR, "day"))
    with pytest.raises(ValueError, match="tenant"):
        refresh(union_tenants(frames), Target(f"{tmp_path}/t", R.FLOOR, "day", by=("tenant",)))
    with pytest.raises(ValueError, match="no tenant"):
        union_tenants(read_tenants(spark, {"a": "x"}, "b%"))


# --- Sources -----------------------------------------------------------------------


def test_sources_by_path_and_by_name(spark, tmp_path):
    events = table(spark, plays(NOON, 2))
    events.write.parquet(f"{tmp_path}/raw")
    assert rows(read_sessions(spark, f"{tmp_path}/raw")) == rows(events)
    name = session_table("default")
    events.withColumn("more", F.lit(1)).write.mode("overwrite").saveAsTable(name)
    assert read_sessions(spark, name).columns == events.columns
    assert rows(read_sessions(spark, name)) == rows(events)


# --- When something breaks ---------------------------------------------------------


def test_a_cut_off_commit_is_done_again(spark, tmp_path):
    """The first day's folder is gone and later days are in place, as in the middle of a commit."""
    target = Target(f"{tmp_path}/t", R.FLOOR, "hour")
    events = plays(NOON - 6 * HOUR, 60)
    refresh(table(spark, [e for e in events if e["eventTime"] < NOON + 3 * HOUR]), target)
    target.mark(spark, {None: "2024-01-01 15:00:00"})
    refresh(table(spark, events), target, since="2024-01-01 15:00:00")
    target.mark(spark, {None: "2024-01-01 15:00:00"})
    for file in Path(f"{tmp_path}/t/bucket_day=2024-01-01").iterdir():
        file.unlink()
    assert refresh(table(spark, events), target) == {None: "2024-01-01 00:00:00"}
    assert rows(target.read(spark)) == rows(R.floor_by_hour(table(spark, events)))
    assert target.cut_off(spark) == {}


def test_a_failed_replace_keeps_the_old_rows(spark, tmp_path):
    target = Target(f"{tmp_path}/t", R.FLOOR, "day")
    rebuild(table(spark, plays(NOON, 3)), target)
    before = rows(target.read(spark))
    broken = target.read(spark).withColumn("total_spins", F.expr("total_spins + raise_error('broken')"))
    with pytest.raises(Exception, match="broken"):
        target.replace(broken)
    assert rows(target.read(spark)) == before


@pytest.mark.parametrize("kind", ["folder", "table"])
def test_rebuilding_one_tenant_drops_its_stale_days(spark, tmp_path, kind):
    place = f"{tmp_path}/t" if kind == "folder" else "default.rebuilt_tenants"
    target = Target(place, R.FLOOR, "day", by=("tenant",))
    early, late = plays(NOON, 3), plays(NOON + 3 * DAY, 3)
    sites = {n: table(spark, early + late) for n in ("a b", "c")}
    rebuild(read_tenants(spark, sites), target)
    rebuild(read_tenants(spark, {"a b": table(spark, late)}), target)
    days = {(r.tenant, r.day_bucket[:10]) for r in target.read(spark).collect()}
    assert days == {("a b", "2024-01-04"), ("c", "2024-01-01"), ("c", "2024-01-04")}
    assert target.newest(spark) == dict.fromkeys(sites, "2024-01-04 00:00:00")


def test_another_money_type_is_refused(spark, tmp_path):
    target = Target(f"{tmp_path}/t", R.FLOOR, "hour")
    refresh(table(spark, plays(NOON, 2)), target)
    before = rows(target.read(spark))
    dear = dict.fromkeys(MONEY_COLUMNS, Decimal("1.25"))
    with pytest.raises(TypeError, match="other types"):
        refresh(table(spark, [event(**dear)], T.DecimalType(18, 2)), target)
    assert rows(target.read(spark)) == before


def test_sources_by_path_keep_their_types(spark, tmp_path):
    dear = dict.fromkeys(MONEY_COLUMNS, Decimal("1.25"))
    table(spark, [event(**dear)], T.DecimalType(18, 2)).write.parquet(f"{tmp_path}/d")
    found = read_sessions(spark, f"{tmp_path}/d")
    assert found.first().updateWon == Decimal("1.25")
    found.drop("duration").write.parquet(f"{tmp_path}/short")
    with pytest.raises(ValueError, match="duration"):
        read_sessions(spark, f"{tmp_path}/short")
    found.withColumn("updateWon", F.lit(1.5)).write.parquet(f"{tmp_path}/floating")
    with pytest.raises(TypeError, match="updateWon"):
        read_sessions(spark, f"{tmp_path}/floating")


def test_many_tenants_are_planned_in_about_linear_time(spark):
    one = table(spark, [event()])

    def seconds(n: int) -> float:
        frames = read_tenants(spark, {f"t{i}": one for i in range(n)})
        start = time.perf_counter()
        union_tenants(frames).columns
        return time.perf_counter() - start

    seconds(20)
    few, many = seconds(60), seconds(240)
    assert many < 10 * few


def test_the_raw_events_are_scanned_once_with_the_bound(spark, tmp_path, monkeypatch):
    events = plays(NOON, 30)
    table(spark, events).write.parquet(f"{tmp_path}/raw")
    target = Target(f"{tmp_path}/t", R.FLOOR, "hour")
    refresh(read_sessions(spark, f"{tmp_path}/raw"), target)
    plans = []

    def noted(df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return written_once(df, name)

    monkeypatch.setattr("spintally.plans.refresh.written_once", noted)
    refresh(read_sessions(spark, f"{tmp_path}/raw"), target)
    targets = {n: t for n, t in default_targets(f"{tmp_path}/all").items() if n != "game_by_day"}
    refresh_all(read_sessions(spark, f"{tmp_path}/raw"), targets)
    del plans[1:]
    refresh_all(read_sessions(spark, f"{tmp_path}/raw"), targets)
    assert plans[0].count("eventTime#") and plans[0].count("Relation") == 1
    assert all("eventTime" not in plan or ">= 17" in plan for plan in plans)
