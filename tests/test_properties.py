"""Relations that must hold between rollups, on the test data."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from spintally.checks.fixture import session_events
from spintally.operators.rows import compact, event_rows, to_days
from spintally.plans import rollups as R
from spintally.schema import SPLIT_MEASURES
from tests.events import rows

DATA = "/root/testdata/sf0.01"
ADDED = (
    "total_coin_in",
    "total_cashable_coin_in",
    "total_coin_out",
    "total_jackpot",
    "total_spins",
    "total_duration",
)
DISTINCT = tuple(m for m in SPLIT_MEASURES if "distinct" in m or "session" in m)


@pytest.fixture(scope="module")
def events(spark):
    return session_events(spark, DATA).cache()


@pytest.mark.parametrize("model", [R.FLOOR, R.GAME], ids=["floor", "game"])
def test_legs_add_up_to_the_whole(events, model):
    rolled = R.rollup(events, model, "hour")
    keys = rolled.columns[: 1 + len(model.keys)]
    leg = F.col("player_type") != "All"

    def legs(agg, name):
        return agg(F.when(leg, F.col(name)))

    def whole(name):
        return F.max(F.when(~leg, F.col(name)))

    broken = [
        ~legs(F.sum, name).eqNullSafe(whole(name)) for name in (*ADDED, "total_net_win")
    ]
    broken += [whole(n) < legs(F.max, n) for n in DISTINCT]
    broken += [whole(n) > legs(F.sum, n) for n in DISTINCT]
    broken += [~legs(F.max, "max_player_budget").eqNullSafe(whole("max_player_budget"))]
    checks = rolled.groupBy(*keys).agg(*(b.alias(f"c{i}") for i, b in enumerate(broken)))
    bad = checks.agg(*(F.count_if(F.col(f"c{i}")) for i in range(len(broken)))).first()
    assert list(bad) == [0] * len(broken)


@pytest.mark.parametrize("model", R.MODELS.values(), ids=R.MODELS)
def test_days_add_up_from_hours(events, model):
    keys = [*model.keys, *(["player_type"] if model.split else [])]
    day = F.concat(F.substring("hour_bucket", 1, 10), F.lit(" 00:00:00")).alias("day_bucket")
    hours = R.rollup(events, model, "hour").groupBy(day, *keys)
    added = hours.agg(*(F.sum(name).alias(name) for name in ADDED))
    assert rows(added) == rows(R.rollup(events, model, "day").select(*added.columns))


@pytest.mark.parametrize("model", R.MODELS.values(), ids=R.MODELS)
def test_row_order_partitions_and_folding_do_not_matter(events, model):
    once = rows(R.rollup(events, model, "day"))
    assert rows(R.rollup(events.orderBy(F.rand(7)).repartition(5), model, "day")) == once
    assert rows(R.rollup(events, model, "day", fold_first=True)) == once
    session_hours = compact(event_rows(events, "hour"))
    assert rows(R.roll_rows(to_days(session_hours), model, "day")) == once


def test_one_group_with_a_third_of_all_rows(spark, events):
    """Whole results under skew, checked against counts by hand."""
    hot = F.pmod(F.hash("eventTime", "sessionUuid"), F.lit(3)) == 0
    skewed = events.withColumns(
        {
            "eventTime": F.when(hot, 1_704_110_400_000).otherwise(F.col("eventTime")),
            "floorLocation": F.when(hot, "0101").otherwise(F.col("floorLocation")),
        }
    ).cache()
    found = {
        r.player_type: r
        for r in R.floor_by_hour(skewed)
        .filter("hour_bucket = '2024-01-01 12:00:00' AND floor_location = '0101'")
        .collect()
    }
    inside = (F.col("eventTime") >= 1_704_110_400_000) & (F.col("eventTime") < 1_704_114_000_000)
    group = skewed.filter(inside & (F.col("type") == "STUpdate") & (F.col("floorLocation") == "0101"))
    raw = group.select("playerCardNumber", "sessionUuid", "devInfoGameTheme").collect()
    assert len(raw) > events.count() / 5
    by_leg = {
        "carded": [r for r in raw if r.playerCardNumber],
        "uncarded": [r for r in raw if not r.playerCardNumber],
        "All": raw,
    }
    for leg, members in by_leg.items():
        assert found[leg].total_spins == len(members)
        assert found[leg].total_session_counts == len({r.sessionUuid for r in members})
        cards = {r.playerCardNumber for r in members} - {None}
        assert found[leg].total_distinct_player_card_numbers == len(cards)
        themes = {r.devInfoGameTheme for r in members} - {None}
        assert found[leg].total_distinct_game_themes == len(themes)
