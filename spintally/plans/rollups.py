"""The six rollups: players, floor locations and games, by hour and by day."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial, reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spintally.functions.buckets import UTC, bucket_label
from spintally.functions.measures import joined_themes, mean, sum_type
from spintally.operators.grouping import distinct_count_name, group_split, group_whole
from spintally.operators.rows import BUCKET, PLAYER_TYPE, compact, event_rows, is_carded
from spintally.operators.slices import since_slice
from spintally.schema import (
    ALL_PLAYERS,
    FLOOR_KEYS,
    FLOOR_TABLE,
    GAME_KEYS,
    PLAYER_KEYS,
    PLAYER_MEASURES,
    SESSION_TABLE,
    SPLIT_MEASURES,
    bucket_column,
)

SESSIONS, ASSETS, THEMES, CARDS = "session_uuid", "asset_number", "game_name", "player_card_number"


@dataclass(frozen=True)
class Model:
    """What one kind of rollup groups by, keeps and counts."""

    name: str
    keys: tuple[str, ...]
    keep: Callable[[], Column]
    split: bool
    source: str = SESSION_TABLE

    @property
    def measures(self) -> tuple[str, ...]:
        return SPLIT_MEASURES if self.split else PLAYER_MEASURES

    @property
    def counted(self) -> tuple[str, ...]:
        """Columns that need a distinct count; a key has one value per group already."""
        wanted = (SESSIONS, ASSETS, THEMES, CARDS)
        return tuple(column for column in wanted if column not in self.keys)

    def columns(self, grain: str, by: tuple[str, ...] = ()) -> tuple[str, ...]:
        """Output columns in contract order, after any ``by`` columns."""
        legs = (PLAYER_TYPE,) if self.split else ()
        return (*by, bucket_column(grain), *self.keys, *legs, *self.measures)


PLAYER = Model("player", PLAYER_KEYS, partial(is_carded, CARDS), split=False)
FLOOR = Model("floor", FLOOR_KEYS, lambda: F.col("floor_location").isNotNull(), True, FLOOR_TABLE)
GAME = Model("game", GAME_KEYS, lambda: F.col(ASSETS).isNotNull(), split=True)
MODELS = {model.name: model for model in (PLAYER, FLOOR, GAME)}


def finish(
    groups: DataFrame, model: Model, grain: str, by: tuple[str, ...], rows: DataFrame
) -> DataFrame:
    """Grouped parts as the contract's columns; ``rows`` gives the types before summing."""
    types = {field.name: field.dataType for field in rows.schema}

    def total(part: str) -> Column:
        return F.col(part).cast(sum_type(types[part]))

    def distinct(column: str) -> Column:
        if column in model.keys:
            return F.col(column).isNotNull().cast("bigint")
        return F.col(distinct_count_name(column))

    spins = F.col("spins")
    bets, plays = F.col("coin_in_known"), F.col("duration_known")
    if model.split:
        # The whole divides by every spin, a leg only by those with a value.
        whole = F.col(PLAYER_TYPE) == ALL_PLAYERS
        bets, plays = F.when(whole, spins).otherwise(bets), F.when(whole, spins).otherwise(plays)
    mean_bet = mean(F.col("coin_in"), bets, types["coin_in"])

    values = {
        "total_coin_in": total("coin_in"),
        "total_cashable_coin_in": total("cashable_coin_in"),
        "total_coin_out": total("coin_out"),
        "total_jackpot": total("jackpot"),
        "total_net_win": F.col("net_win").cast(sum_type(types["coin_in"])),
        "max_player_budget": F.col("budget"),
        "avg_bet_size": mean_bet,
        "total_avg_bet_size": mean_bet,
        "total_spins": spins,
        "total_session_counts": distinct(SESSIONS),
        "total_distinct_asset_counts": distinct(ASSETS),
        "total_distinct_game_themes": distinct(THEMES),
        "distinct_game_themes": distinct(THEMES),
        "total_distinct_player_card_numbers": distinct(CARDS),
        "total_duration": F.col("duration"),
        "avg_duration": mean(F.col("duration"), plays, T.LongType()),
        "game_theme_list": joined_themes(F.col(THEMES)),
        bucket_column(grain): bucket_label(F.col(BUCKET), grain),
    }
    columns = model.columns(grain, by)
    return groups.select(*(values.get(c, F.col(c)).alias(c) for c in columns))


def roll_rows(
    rows: DataFrame,
    model: Model,
    grain: str,
    by: tuple[str, ...] = (),
    null_safe_totals: bool = True,
    fold_first: bool = False,
    typed: DataFrame | None = None,
) -> DataFrame:
    """Roll up rows of the given grain, be they single events or compacted ones.

    ``typed`` are the rows of single events that compacted ones come from: each sum widens a
    decimal, and the result's types follow the events'.
    """
    typed = rows if typed is None else typed
    keys = (*by, BUCKET, *model.keys)
    kept = rows.filter(model.keep())
    if fold_first:
        kept = compact(kept, by, dict.fromkeys((*model.keys, *model.counted)))
    if not model.split:
        return finish(
            group_whole(kept, keys, model.counted, listed=THEMES), model, grain, by, typed
        )
    groups = group_split(kept, keys, model.counted, carrier=CARDS)
    return finish(complete_totals(groups, keys, null_safe_totals), model, grain, by, typed)


def complete_totals(groups: DataFrame, keys: tuple[str, ...], null_safe: bool) -> DataFrame:
    """Without ``null_safe``, leaves out the ``All`` rows of groups with a NULL key."""
    if null_safe:
        return groups
    complete = reduce(and_, (F.col(k).isNotNull() for k in keys))
    return groups.filter((F.col(PLAYER_TYPE) != ALL_PLAYERS) | complete)


def rollup(
    events: DataFrame,
    model: Model,
    grain: str,
    since: str | None = None,
    *,
    lookback: int = 0,
    tz: str = UTC,
    by: tuple[str, ...] = (),
    null_safe_totals: bool = True,
    fold_first: bool = False,
) -> DataFrame:
    """Roll up raw events, all of them or from bucket ``since`` onward.

    ``fold_first`` first reduces the plays of a session in a bucket to one row.
    That costs a shuffle and saves work on every play after it, so it pays where
    sessions have many plays, and loses where they have one or two. ``by`` names
    further key columns, and ``null_safe_totals=False`` leaves out the ``All`` row
    of a group with a NULL key.
    """
    rows = event_rows(since_slice(events, since, grain, tz, lookback), grain, tz, by)
    return roll_rows(rows, model, grain, by, null_safe_totals, fold_first)


def in_order(rolled: DataFrame, model: Model, grain: str) -> DataFrame:
    """Rows by bucket, for reading out; a stored table keeps no order.

    Rows of one bucket are further ordered by key, so that a bucket with many of
    them can be sorted by several tasks.
    """
    return rolled.orderBy(*model.columns(grain)[: 1 + len(model.keys)])


player_by_hour = partial(rollup, model=PLAYER, grain="hour")
player_by_day = partial(rollup, model=PLAYER, grain="day")
floor_by_hour = partial(rollup, model=FLOOR, grain="hour")
floor_by_day = partial(rollup, model=FLOOR, grain="day")
game_by_hour = partial(rollup, model=GAME, grain="hour")
game_by_day = partial(rollup, model=GAME, grain="day")
