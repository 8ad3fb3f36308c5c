"""The whole run, over one database and over several."""

from __future__ import annotations

from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import types as T

from spintally import job
from spintally.job import RAW_TABLES, parse, run
from spintally.plans import rollups as R
from spintally.plans.refresh import default_targets
from spintally.plans.targets import TargetError
from spintally.schema import MONEY_COLUMNS
from tests.events import HOUR, NOON, event, rows, table


@pytest.fixture
def database(spark, tmp_path):
    def make(name: str, hours: int) -> str:
        plays = [event(at=NOON + h * HOUR, card=["", "P1"][h % 2]) for h in range(hours)]
        floors = [event(at=NOON + h * HOUR, floorLocation=name) for h in range(hours)]
        table(spark, plays).write.mode("overwrite").parquet(f"{tmp_path}/{name}/session_data")
        table(spark, floors).write.mode("overwrite").parquet(f"{tmp_path}/{name}/mc_sessions")
        return f"{tmp_path}/{name}"

    return make


def test_one_database(spark, tmp_path, database):
    source = database("a", 5)
    starts = run(spark, source, f"{tmp_path}/out", rebuilt=())
    assert all(start == {None: None} for start in starts.values())
    targets = default_targets(f"{tmp_path}/out")
    for name, target in targets.items():
        raw = "mc_sessions" if target.model is R.FLOOR else "session_data"
        full = R.rollup(spark.read.parquet(f"{source}/{raw}"), target.model, target.grain)
        assert rows(target.read(spark)) == rows(full), name


def test_several_databases_and_a_rerun_of_one(spark, tmp_path, database):
    sources = {"site_a": database("a", 3), "SITE_b": database("b", 4), "other": database("c", 2)}
    options = {"pattern": "site_%", "models": ["floor_by_day", "game_by_day"]}
    run(spark, sources, f"{tmp_path}/out", **options)
    targets = default_targets(f"{tmp_path}/out", by=("tenant",))
    floor = targets["floor_by_day"].read(spark)
    assert {(r.tenant, r.floor_location) for r in floor.collect()} == {
        ("site_a", "a"),
        ("SITE_b", "b"),
    }
    assert targets["player_by_day"].read(spark) is None

    # Also a rollup that is replaced in full keeps the other tenant.
    database("a", 9)
    run(spark, sources, f"{tmp_path}/out", only=["site_a"], **options)
    for target in (targets["floor_by_day"], targets["game_by_day"]):
        whole = target.read(spark).filter("player_type = 'All'")
        assert {r.tenant: r.total_spins for r in whole.collect()} == {"site_a": 9, "SITE_b": 4}


def test_arguments():
    many = parse(["--target", "lake.r", "a=lake.a", "b=/raw/b", "--models", "game_by_day"])
    assert many.sources == {"a": "lake.a", "b": "/raw/b"}
    assert (many.models, many.rebuilt, many.tz) == (["game_by_day"], ["game_by_day"], "UTC")
    assert parse(["--target", "t", "lake.a"]).sources == "lake.a"
    with pytest.raises(SystemExit):
        parse(["--target", "t", "lake.a", "lake.b"])


def test_unknown_model(spark, tmp_path, database):
    with pytest.raises(ValueError, match="shop_by_hour"):
        run(spark, database("a", 1), f"{tmp_path}/out", models=["shop_by_hour"])


def test_sources_fail_apart(spark, tmp_path):
    """One source is missing and one breaks while it is read; the third is refreshed."""
    for name in ("good", "broken"):
        for raw in RAW_TABLES:
            table(spark, [event()]).write.parquet(f"{tmp_path}/{name}/{raw}")
    for file in Path(f"{tmp_path}/broken").rglob("part-*.parquet"):
        file.write_bytes(file.read_bytes()[:-200] + b"x" * 100 + file.read_bytes()[-100:])
    sources = {name: f"{tmp_path}/{name}" for name in ("good", "broken", "missing")}
    with pytest.raises(ExceptionGroup, match="missing") as caught:
        run(spark, sources, f"{tmp_path}/out", models=["floor_by_day", "player_by_day"])
    assert "good" not in str(caught.value)
    stored = spark.read.parquet(f"{tmp_path}/out/floor_by_day")
    assert {r.tenant for r in stored.collect()} == {"good"}


def test_a_rollup_can_have_a_place_of_its_own(spark, tmp_path):
    for raw in RAW_TABLES:
        table(spark, [event()]).write.parquet(f"{tmp_path}/s/{raw}")
    run(spark, f"{tmp_path}/s", f"{tmp_path}/out", models=["game_by_day", "floor_by_day"], places={"game_by_day": f"{tmp_path}/apart"})
    assert spark.read.parquet(f"{tmp_path}/apart/game_by_day").count() > 0
    assert Path(f"{tmp_path}/out/floor_by_day").exists()
    assert not Path(f"{tmp_path}/out/game_by_day").exists()


def test_a_failing_source_is_found_by_halves(spark, tmp_path, monkeypatch):
    """One broken file among 32 tenants costs about two joint runs a halving, not 32."""
    for name in ("good", "broken"):
        for raw in RAW_TABLES:
            table(spark, [event()]).write.parquet(f"{tmp_path}/{name}/{raw}")
    for file in Path(f"{tmp_path}/broken").rglob("part-*.parquet"):
        whole = file.read_bytes()
        pages = len(whole) - 8 - int.from_bytes(whole[-8:-4], "little")
        file.write_bytes(b"PAR1" + b"\xff" * (pages - 4) + whole[pages:])  # the footer stays, so that only a job fails
        file.with_name(f".{file.name}.crc").unlink()
    sources = {f"t{i:02}": f"{tmp_path}/{'broken' if i == 13 else 'good'}" for i in range(32)}
    runs = []
    every = job.refresh_all
    monkeypatch.setattr(job, "refresh_all", lambda events, *rest, **more: runs.append(len(events)) or every(events, *rest, **more))
    with pytest.raises(ExceptionGroup, match="sources failed: t13$") as caught:
        run(spark, sources, f"{tmp_path}/out", models=["floor_by_day"])
    assert len(caught.value.exceptions) == 1
    assert sorted(runs) == sorted([32, 16, 16, 8, 8, 4, 4, 2, 2, 1, 1])
    stored = spark.read.parquet(f"{tmp_path}/out/floor_by_day")
    assert {r.tenant for r in stored.select("tenant").collect()} == set(sources) - {"t13"}


def test_money_of_another_type(spark, tmp_path, monkeypatch):
    """A source that differs is left out without a run; targets that differ from all end the run at once."""
    dear = dict.fromkeys(MONEY_COLUMNS, Decimal("1.25"))
    for raw in RAW_TABLES:
        table(spark, [event()]).write.parquet(f"{tmp_path}/whole/{raw}")
        table(spark, [event(**dear)], T.DecimalType(18, 2)).write.parquet(f"{tmp_path}/dear/{raw}")
    runs = []
    every = job.refresh_all
    monkeypatch.setattr(job, "refresh_all", lambda events, *rest, **more: runs.append(list(events)) or every(events, *rest, **more))
    sources = {"a": f"{tmp_path}/whole", "b": f"{tmp_path}/whole", "c": f"{tmp_path}/dear"}
    for _ in range(2):
        with pytest.raises(ExceptionGroup, match="sources failed: c$"):
            run(spark, sources, f"{tmp_path}/out", models=["floor_by_day"])
    assert runs == [["a", "b"]] * 2
    with pytest.raises(TargetError, match="every source"):
        run(spark, {"c": sources["c"], "d": sources["c"]}, f"{tmp_path}/out", models=["floor_by_day"])
    assert len(runs) == 2
