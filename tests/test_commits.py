"""Commits that are cut off between deleting a partition and putting the new one in its place."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from spintally.plans import rollups as R
from spintally.plans.refresh import default_targets, rebuild, refresh, refresh_all
from spintally.plans.targets import Target
from spintally.sources.tenants import read_tenants
from tests.events import HOUR, NOON, event, rows, table

LAYOUTS = pytest.mark.parametrize(
    ("grain", "day_folders"), [("hour", True), ("hour", False), ("day", True)]
)
KINDS = pytest.mark.parametrize("kind", ["folder", "table"])


class CutOff(Exception):
    pass


def plays(hours: int, start: int = NOON, floor: str = "0101") -> list[dict]:
    return [event(at=start + h * HOUR, card=["P1", None][h % 2], floorLocation=floor) for h in range(hours)]


def place(kind: str, tmp_path, name: str) -> str:
    return f"{tmp_path}/t" if kind == "folder" else f"default.cut_{name}".lower()


@pytest.fixture
def cut_off(monkeypatch):
    """Inside ``with cut_off(n):`` commits lose their ``n``-th of the swapped partitions, and stop."""

    def of(lost: int):
        class Patched:
            def __enter__(self):
                whole = Target.upsert

                def upsert(target, ready):
                    spark = ready.sparkSession
                    keys = target._arranged(ready).select(*target.partitions).distinct()
                    swapped = {tuple(row) for row in keys.collect()}
                    whole(target, ready)
                    names = sorted(target.partition_names(spark), key=str)
                    names = [one for one in names if tuple(one[c] for c in target.partitions) in swapped]
                    target._drop(spark, [names[lost]])
                    raise CutOff

                monkeypatch.setattr(Target, "upsert", upsert)

            def __exit__(self, kind, error, trace):
                monkeypatch.undo()
                return kind is CutOff

        return Patched()

    return of


@LAYOUTS
@KINDS
def test_a_plain_rerun_brings_every_row_back(spark, tmp_path, cut_off, kind, grain, day_folders):
    target = Target(place(kind, tmp_path, f"plain_{grain}_{day_folders}"), R.FLOOR, grain, day_folders=day_folders)
    events = plays(5 * 24)
    full = rows(R.rollup(table(spark, events), R.FLOOR, grain))
    refresh(table(spark, events), target)
    since = "2024-01-03 00:00:00"
    with cut_off(-2 if grain == "day" else -3):
        refresh(table(spark, events), target, since=since)
    assert rows(target.read(spark)) != full
    assert target.cut_off(spark) == {None: since}
    assert refresh(table(spark, events), target) == {None: since}
    assert rows(target.read(spark)) == full
    assert target.cut_off(spark) == {}


@LAYOUTS
@KINDS
def test_a_first_commit_that_was_cut_off(spark, tmp_path, cut_off, kind, grain, day_folders):
    """Later days are there and an earlier one is not."""
    target = Target(place(kind, tmp_path, f"first_{grain}_{day_folders}"), R.FLOOR, grain, day_folders=day_folders)
    events = plays(3 * 24)
    with cut_off(0):
        refresh(table(spark, events), target)
    assert target.newest(spark) != {}
    assert refresh(table(spark, events), target) == {None: None}
    assert rows(target.read(spark)) == rows(R.rollup(table(spark, events), R.FLOOR, grain))


@KINDS
@pytest.mark.parametrize("method", ["_move", "_drop"])
def test_a_rebuild_that_was_cut_off(spark, tmp_path, monkeypatch, kind, method):
    target = Target(place(kind, tmp_path, f"rebuild{method}"), R.GAME, "day")
    old, new = plays(4 * 24), plays(5 * 24)
    rebuild(table(spark, old), target)
    step = getattr(Target, "_drop" if kind == "table" else method)

    def stop(target, spark, *rest):
        if step.__name__ == "_move":
            target._drop(spark, target.partition_names(spark)[:2])
        raise CutOff

    monkeypatch.setattr(Target, step.__name__, stop)
    with pytest.raises(CutOff):
        if kind == "table":
            monkeypatch.setattr(Target, "upsert", stop)
        rebuild(table(spark, new), target)
    monkeypatch.undo()
    if kind == "table":
        target._drop(spark, target.partition_names(spark)[1:2])
    assert refresh(table(spark, new), target) == {None: None}
    assert rows(target.read(spark)) == rows(R.rollup(table(spark, new), R.GAME, "day"))


@LAYOUTS
@KINDS
def test_a_rerun_of_one_tenant_keeps_the_notes_of_others(spark, tmp_path, cut_off, kind, grain, day_folders):
    target = Target(
        place(kind, tmp_path, f"tenants_{grain}_{day_folders}"), R.FLOOR, grain, by=("tenant",), day_folders=day_folders
    )
    events = {name: plays(4 * 24, floor=name) for name in ("a", "b's")}
    sites = read_tenants(spark, {name: table(spark, own) for name, own in events.items()})
    refresh(sites, target)
    full = rows(target.read(spark))
    since = "2024-01-02 00:00:00"
    with cut_off(2):
        refresh(sites, target, since=since)
    with cut_off(-2):
        refresh({"a": sites["a"]}, target, since="2024-01-03 00:00:00")
    assert target.cut_off(spark) == {"a": since, "b's": since}
    assert refresh({"a": sites["a"]}, target) == {"a": since}
    assert target.cut_off(spark) == {"b's": since}
    assert refresh(sites, target)["b's"] == since
    assert rows(target.read(spark)) == full
    assert target.cut_off(spark) == {}


def test_a_note_of_the_whole_target_holds_for_every_tenant(spark, tmp_path):
    target = Target(f"{tmp_path}/t", R.FLOOR, "day", by=("tenant",))
    sites = read_tenants(spark, {name: table(spark, plays(50)) for name in ("a", "b")})
    refresh(sites, target)
    target.mark(spark, {None: "2024-01-02 00:00:00"})
    assert set(refresh(sites, target).values()) == {"2024-01-02 00:00:00"}


def test_a_failed_run_notes_nothing(spark, tmp_path):
    """Rows are worked out before the commit begins."""
    target = Target(f"{tmp_path}/t", R.FLOOR, "day")
    rebuild(table(spark, plays(30)), target)
    broken = target.read(spark).withColumn("total_spins", F.expr("total_spins + raise_error('broken')"))
    with pytest.raises(Exception, match="broken"):
        target.replace(broken)
    assert target.cut_off(spark) == {}


@LAYOUTS
def test_a_run_lists_its_target_once(spark, tmp_path, monkeypatch, grain, day_folders):
    target = Target(f"{tmp_path}/t", R.FLOOR, grain, day_folders=day_folders)
    events = table(spark, plays(50))
    refresh(events, target)
    listed = []
    names = Target.partition_names
    monkeypatch.setattr(Target, "partition_names", lambda self, spark: listed.append(1) or names(self, spark))
    refresh(events, target)
    assert len(listed) == 1
    targets = default_targets(f"{tmp_path}/all")
    refresh_all(events, targets)
    listed.clear()
    refresh_all(events, targets)
    assert len(listed) == len(targets)


def test_old_days_are_not_opened(spark, tmp_path):
    """Only the folders that a refresh may swap are read."""
    target = Target(f"{tmp_path}/t", R.FLOOR, "hour")
    events = plays(6 * 24)
    refresh(table(spark, events), target)
    for day in ("2024-01-01", "2024-01-02"):
        for file in (tmp_path / "t" / f"bucket_day={day}").glob("*.parquet"):
            file.write_bytes(b"not parquet")
    assert refresh(table(spark, events), target, lookback=30) == {None: "2024-01-06 05:00:00"}
    assert target.newest(spark) == {None: "2024-01-07 11:00:00"}
