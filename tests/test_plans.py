"""What Spark makes of the rollups: scans, filters, shuffles."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from spintally.checks import queries
from spintally.checks.fixture import session_events
from spintally.plans import rollups as R
from spintally.plans.refresh import rebuild
from spintally.plans.targets import DAY_FOLDER, Target
from spintally.sources import scratch
from spintally.sources.sessions import read_sessions

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "session_data")
    session_events(spark, DATA).write.parquet(path)
    return read_sessions(spark, path)


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def count(df, node: str) -> int:
    return len(re.findall(rf"^\(\d+\) {node}", plan(df), re.MULTILINE))


@pytest.mark.parametrize("grain", ["hour", "day"])
@pytest.mark.parametrize("model", R.MODELS.values(), ids=R.MODELS)
def test_one_scan_two_shuffles_no_join_no_python(raw, model, grain):
    rolled = R.rollup(raw, model, grain, since="2024-01-15 00:00:00")
    assert count(rolled, "Scan parquet") == 1
    assert count(rolled, "Exchange") == 2
    assert not re.search(r"Join|Python|Cartesian|Window", plan(rolled))


def test_filters_and_columns_reach_the_scan(raw):
    text = plan(R.floor_by_hour(raw, since="2024-01-15 10:00:00"))
    pushed = re.search(r"PushedFilters: (.*)", text).group(1)
    assert "EqualTo(type,STUpdate)" in pushed
    assert "IsNotNull(floorLocation)" in pushed
    assert "GreaterThanOrEqual(eventTime,1705312800000)" in pushed
    read = re.search(r"ReadSchema: (.*)", text).group(1)
    assert "gameId:" not in read and ",ess:" not in read

    text = plan(R.player_by_day(raw))
    assert "Not(EqualTo(playerCardNumber,))" in re.search(r"PushedFilters: (.*)", text).group(1)
    text = plan(R.game_by_day(raw))
    assert "IsNotNull(assetNumber)" in re.search(r"PushedFilters: (.*)", text).group(1)


def test_unused_measures_are_not_read(raw):
    text = plan(R.floor_by_day(raw).select("day_bucket", "total_jackpot"))
    read = re.search(r"ReadSchema: (.*)", text).group(1)
    assert "updateJackpot" in read and "Wager" not in read and "duration" not in read


def test_zone_slices_also_reach_the_scan(raw):
    text = plan(R.floor_by_hour(raw, since="2024-01-15 10:00:00", tz="America/New_York"))
    assert "GreaterThanOrEqual(eventTime,1705330800000)" in text


def test_newest_day_is_read_alone(spark, raw, tmp_path):
    target = Target(f"{tmp_path}/t", R.FLOOR, "hour")
    rebuild(raw, target)
    newest = target.stored(spark).filter(F.col(DAY_FOLDER) == "2024-01-30").agg(F.max("hour_bucket"))
    assert re.search(r"PartitionFilters: \[.*bucket_day.*2024-01-30", plan(newest))
    assert re.search(r"ReadSchema: struct<hour_bucket:string>", plan(newest))


def test_writes_gather_rows_by_partition(raw):
    arranged = Target("/nowhere", R.FLOOR, "hour")._arranged(R.floor_by_hour(raw))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(arranged)


@pytest.mark.parametrize(
    "name", ["floor_legs", "game_legs", "distinct_totals", "floor_totals_join", "game_all_rows", "union_all_legs"]
)
def test_steps_share_one_grouping_of_the_raw_rows(spark, monkeypatch, name):
    """What is written is the members, from one shuffle of the raw rows; the steps read nothing else."""
    written = []

    def noted(df, called):
        written.append((called, df))
        return scratch.kept(df, called)

    monkeypatch.setattr(queries, "kept", noted)
    found = queries.queries()[name](spark, DATA)
    [(called, members)] = written
    assert called == "members"
    assert count(members, "Exchange") == 1 and count(members, "Scan parquet") == 1
    text = plan(found)
    assert "events.parquet" not in text
    assert not re.search(r"Join|Window|Python", text)
