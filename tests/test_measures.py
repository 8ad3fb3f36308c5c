"""Measures, legs and whole-group rows on a few hand-made events."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spintally.operators.grouping import members
from spintally.operators import legs as steps
from spintally.operators.rows import BUCKET, event_rows
from spintally.plans import rollups as R
from spintally.schema import SESSION_SCHEMA
from spintally.sources.sessions import conform
from tests.events import DAY, HOUR, NOON, by_type, event, rows, table


def test_all_measures_of_one_player(spark):
    events = table(
        spark,
        [
            event(
                updateCashableWager=100,
                updateRestrictedWager=20,
                updateOORVCashableWager=3,
                updateOORVRestrictedWager=4,
                updateWon=50,
                updateOORVWon=6,
                updateJackpot=7,
                updateOORVJackpot=8,
                maxCashableRisked=900,
                duration=5,
            ),
            event(sessionUuid="S2", assetNumber="A2", devInfoGameTheme="Zoo", duration=None),
        ],
    )
    [found] = R.player_by_hour(events).collect()
    assert found.asDict() == {
        "hour_bucket": "2024-01-01 12:00:00",
        "player_card_number": "P1",
        "total_coin_in": 227,
        "total_cashable_coin_in": 203,
        "total_coin_out": 56,
        "total_jackpot": 15,
        "total_net_win": 227 - 56 - 15,
        "max_player_budget": 900,
        "avg_bet_size": 113.5,
        "total_spins": 2,
        "total_session_counts": 2,
        "total_distinct_asset_counts": 2,
        "total_duration": 5,
        "avg_duration": 5.0,
        "distinct_game_themes": 2,
        "game_theme_list": "Theme, Zoo",
    }


def test_cards_null_empty_and_set(spark):
    events = table(spark, [event(card=None), event(card=""), event(card=""), event(card="P1")])
    found = by_type(R.floor_by_hour(events))
    assert {t: r.total_spins for t, r in found.items()} == {"carded": 1, "uncarded": 3, "All": 4}
    # An empty card is one distinct value, a NULL card none.
    cards = {t: r.total_distinct_player_card_numbers for t, r in found.items()}
    assert cards == {"carded": 1, "uncarded": 1, "All": 2}
    assert [r.player_card_number for r in R.player_by_hour(events).collect()] == ["P1"]


def test_only_updates_count(spark):
    events = table(spark, [event(), event(type="STEnd"), event(type="stupdate")])
    assert [r.total_spins for r in R.player_by_day(events).collect()] == [1]


def test_null_wager_leaves_coin_in_unknown_but_counts_as_a_spin(spark):
    events = table(spark, [event(), event(updateRestrictedWager=None)])
    found = by_type(R.floor_by_hour(events))
    assert (found["carded"].total_coin_in, found["carded"].total_cashable_coin_in) == (100, 200)
    # The leg divides by wagers it knows, the whole by every spin.
    assert found["carded"].total_avg_bet_size == 100.0
    assert found["All"].total_avg_bet_size == 50.0


def test_whole_net_win_skips_a_leg_without_one(spark):
    events = table(
        spark,
        [event(card=None, updateCashableWager=None, updateWon=30), event(updateWon=40)],
    )
    found = by_type(R.floor_by_hour(events))
    assert found["uncarded"].total_net_win is None
    assert found["uncarded"].total_avg_bet_size is None
    assert found["carded"].total_net_win == 60
    assert found["All"].total_net_win == 60
    assert found["All"].total_coin_out == 70


def test_no_duration_at_all(spark):
    found = by_type(R.floor_by_hour(table(spark, [event(duration=None)])))
    assert {r.total_duration for r in found.values()} == {None}
    assert {r.avg_duration for r in found.values()} == {None}


def test_null_game_keys(spark):
    events = table(
        spark,
        [
            event(ess=None, gameId=None, devInfoGameTheme=None),
            event(ess=None, gameId=None, devInfoGameTheme=None, card=None),
            event(),
            event(assetNumber=None),
        ],
    )
    found = R.game_by_hour(events)
    assert found.filter("player_type = 'All'").count() == 2
    assert found.filter("ess IS NULL").count() == 3
    # Themes are counted per game: none where the name is missing.
    counts = {(r.game_name, r.total_distinct_game_themes) for r in found.collect()}
    assert counts == {(None, 0), ("Theme", 1)}
    literal = R.game_by_hour(events, null_safe_totals=False)
    assert literal.filter("player_type = 'All'").count() == 1
    assert literal.filter("player_type <> 'All'").count() == 3


def test_session_in_both_legs_is_one_session(spark):
    found = by_type(R.floor_by_hour(table(spark, [event(), event(card="")])))
    assert {t: r.total_session_counts for t, r in found.items()} == {
        "carded": 1,
        "uncarded": 1,
        "All": 1,
    }
    assert found["All"].max_player_budget == 500


def test_empty_floor_is_a_floor_and_null_is_not(spark):
    events = table(spark, [event(floorLocation=""), event(floorLocation=None)])
    assert {r.floor_location for r in R.floor_by_day(events).collect()} == {""}


@pytest.mark.parametrize(
    ("themes", "count", "text"),
    [
        (["b", "a", "b", None], 2, "a, b"),
        ([None], 0, None),
        ([""], 1, ""),
        (["", "a"], 2, ", a"),
        (["a", "B", "A", "b"], 4, "A, B, a, b"),
    ],
)
def test_theme_list(spark, themes, count, text):
    events = table(spark, [event(devInfoGameTheme=t) for t in themes])
    [found] = R.player_by_day(events).collect()
    assert (found.distinct_game_themes, found.game_theme_list) == (count, text)


def test_output_columns_in_contract_order(spark):
    none = table(spark, [])
    for model in R.MODELS.values():
        for grain in ("hour", "day"):
            rolled = R.rollup(none, model, grain)
            assert tuple(rolled.columns) == model.columns(grain)
            assert rolled.collect() == []


def test_decimal_money_stays_decimal(spark):
    money = T.DecimalType(18, 2)
    zero = dict.fromkeys((f.name for f in SESSION_SCHEMA if f.name.startswith("update")), Decimal(0))
    base = zero | {"maxCashableRisked": Decimal("5.25")}
    events = table(
        spark,
        [
            event(**base | {"updateCashableWager": Decimal("0.10")}),
            event(**base | {"updateCashableWager": Decimal("0.20")}),
            event(card="", **base | {"updateCashableWager": Decimal("0.05")}),
        ],
        money,
    )
    rolled = R.floor_by_hour(events)
    types = dict(rolled.dtypes)
    wagers = F.sum(sum(F.col(c) for c in ("updateCashableWager",)))
    assert types["total_coin_in"] == "decimal(31,2)"
    assert types["max_player_budget"] == "decimal(18,2)"
    assert types["total_avg_bet_size"] == "decimal(25,6)"
    found = by_type(rolled)
    assert found["carded"].total_coin_in == Decimal("0.30")
    assert found["carded"].total_avg_bet_size == Decimal("0.15")
    assert found["All"].total_avg_bet_size == Decimal("0.116667")
    assert events.agg(wagers).first()[0] == found["All"].total_coin_in


def test_conform_refuses_floats_and_missing_columns(spark):
    events = table(spark, [event()])
    assert conform(events.withColumn("updateWon", F.lit(1))).dtypes == events.dtypes
    with pytest.raises(TypeError, match="updateWon"):
        conform(events.withColumn("updateWon", F.lit(1.5)))
    with pytest.raises(ValueError, match="duration"):
        conform(events.drop("duration"))


def test_one_pass_equals_the_single_steps(spark):
    events = table(
        spark,
        [
            event(at=NOON + i * HOUR // 3, card=[None, "", "P1", "P2"][i % 4], ess=[None, "E1"][i % 2],
                  sessionUuid=f"S{i % 3}", updateWon=[None, 5, 7][i % 3])
            for i in range(20)
        ],
    )
    for model in (R.FLOOR, R.GAME):
        kept = event_rows(events, "hour").filter(model.keep())
        keys = (BUCKET, *model.keys)
        found = members(kept, keys, model.counted, R.CARDS)
        for safe in (True, False):
            stepwise = steps.with_all_rows(found, keys, model.counted, safe)
            stepwise = R.finish(stepwise, model, "hour", (), kept)
            once = R.rollup(events, model, "hour", null_safe_totals=safe)
            assert rows(once) == rows(stepwise)


def test_edges_of_buckets(spark):
    times = [NOON, NOON + HOUR - 1, NOON + HOUR, NOON + DAY // 2 - 1, NOON + DAY // 2, -1, 0]
    events = table(spark, [event(at=t) for t in times])
    hours = {r.hour_bucket: r.total_spins for r in R.player_by_hour(events).collect()}
    assert hours == {
        "2024-01-01 12:00:00": 2,
        "2024-01-01 13:00:00": 1,
        "2024-01-01 23:00:00": 1,
        "2024-01-02 00:00:00": 1,
        "1969-12-31 23:00:00": 1,
        "1970-01-01 00:00:00": 1,
    }
    days = {r.day_bucket: r.total_spins for r in R.player_by_day(events).collect()}
    assert days == {
        "2024-01-01 00:00:00": 4,
        "2024-01-02 00:00:00": 1,
        "1969-12-31 00:00:00": 1,
        "1970-01-01 00:00:00": 1,
    }
