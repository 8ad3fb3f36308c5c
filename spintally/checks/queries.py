"""Every operator and rollup as a query over a test-data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spintally.checks.fixture import session_events
from spintally.functions.buckets import bucket_label, bucket_number
from spintally.functions.measures import event_measures, player_type
from spintally.operators import legs as steps
from spintally.operators.grouping import distinct_count_name, members
from spintally.operators.rows import BUCKET, PLAYER_TYPE, event_rows, is_carded, is_update
from spintally.operators.slices import high_watermark, since_slice
from spintally.plans import rollups
from spintally.plans.measured import (
    FLOOR_ACTIVITY,
    FLOOR_OCCUPANCY,
    GAME_VELOCITY,
    PLAYER_BUDGETS,
    PLAYER_VELOCITY,
    Measured,
    measure,
    refresh_measured,
)
from spintally.plans.refresh import default_targets, rebuild, refresh, refresh_all
from spintally.plans.rollups import CARDS, FLOOR, GAME, PLAYER, THEMES, Model, finish, rollup
from spintally.plans.states import refresh_days, state_target
from spintally.plans.targets import Target
from spintally.schema import HOUR_BUCKET, MONEY_COLUMNS, bucket_column
from spintally.sources.scratch import kept, scratch_path
from spintally.sources.tenants import TENANT, read_tenants, union_tenants

Query = Callable[[SparkSession, str], DataFrame]

SITES = "site_%"


# --- Rollups -----------------------------------------------------------------


def _rollup(model: Model, grain: str, **options) -> Query:
    return lambda spark, sf: rollup(session_events(spark, sf), model, grain, **options)


def _columns(model: Model, grain: str, *measures: str) -> Query:
    """Some columns of a rollup; Catalyst drops the rest from the plan."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        legs = (PLAYER_TYPE,) if model.split else ()
        rolled = rollup(session_events(spark, sf), model, grain)
        return rolled.select(bucket_column(grain), *model.keys, *legs, *measures)

    return query


def ordered_floor(spark: SparkSession, sf: str) -> DataFrame:
    rolled = rollups.floor_by_hour(session_events(spark, sf))
    return rollups.in_order(rolled, FLOOR, "hour")


# --- Events ------------------------------------------------------------------


def measure_columns(spark: SparkSession, sf: str) -> DataFrame:
    updates = session_events(spark, sf).filter(is_update())
    return updates.select("eventTime", "sessionUuid", *event_measures())


def player_type_tag(spark: SparkSession, sf: str) -> DataFrame:
    tag = player_type(F.col("playerCardNumber")).alias(PLAYER_TYPE)
    return session_events(spark, sf).select("eventTime", "playerCardNumber", tag)


def _bucket(grain: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        label = bucket_label(bucket_number(F.col("eventTime"), grain), grain)
        return session_events(spark, sf).select("eventTime", label.alias(bucket_column(grain)))

    return query


def _filter(condition: Callable) -> Query:
    return lambda spark, sf: session_events(spark, sf).filter(condition())


def _midway(events: DataFrame) -> int:
    low, high = events.agg(F.min("eventTime"), F.max("eventTime")).first()
    return (low + high) // 2


def _slice(model: Model, grain: str) -> Query:
    """Events that a refresh would read if the first half of history was stored."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        events = session_events(spark, sf)
        stored = rollup(events.filter(F.col("eventTime") < _midway(events)), model, grain)
        return since_slice(events, high_watermark(stored, bucket_column(grain)), grain)

    return query


# --- Legs, totals, join and union, one step at a time --------------------------


def _members(spark: SparkSession, sf: str, model: Model, grain: str) -> tuple[DataFrame, ...]:
    """The members of each key, from one grouping of the raw rows, as a table that several steps read."""
    rows = event_rows(session_events(spark, sf), grain).filter(model.keep())
    keys = (BUCKET, *model.keys)
    return kept(members(rows, keys, model.counted, CARDS), "members"), keys, rows


def _legs(model: Model, grain: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        found, keys, rows = _members(spark, sf, model, grain)
        return finish(steps.legs(found, keys, model.counted), model, grain, (), rows)

    return query


def _all_rows(model: Model, grain: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        found, keys, rows = _members(spark, sf, model, grain)
        leg_rows = steps.legs(found, keys, model.counted)
        totals = steps.distinct_totals(found, keys, model.counted)
        return finish(steps.all_rows(leg_rows, totals, keys), model, grain, (), rows)

    return query


def _totals_join(model: Model, grain: str, null_safe: bool = True) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        found, keys, rows = _members(spark, sf, model, grain)
        folded = steps.fold_legs(steps.legs(found, keys, model.counted), keys)
        totals = steps.distinct_totals(found, keys, model.counted)
        joined = steps.join_totals(folded, totals, keys, null_safe)
        done = finish(joined.withColumn(PLAYER_TYPE, F.lit(None)), model, grain, (), rows)
        return done.drop(PLAYER_TYPE, "total_avg_bet_size", "avg_duration")

    return query


def distinct_totals(spark: SparkSession, sf: str) -> DataFrame:
    found, keys, _ = _members(spark, sf, FLOOR, "hour")
    totals = steps.distinct_totals(found, keys, FLOOR.counted)
    names = {
        "session_uuid": "total_session_counts",
        "asset_number": "total_distinct_asset_counts",
        THEMES: "total_distinct_game_themes",
        CARDS: "total_distinct_player_card_numbers",
    }
    return totals.select(
        bucket_label(F.col(BUCKET), "hour").alias(HOUR_BUCKET),
        "floor_location",
        *(F.col(distinct_count_name(c)).alias(name) for c, name in names.items()),
    )


def union_all_legs(spark: SparkSession, sf: str) -> DataFrame:
    found, keys, rows = _members(spark, sf, GAME, "day")
    return finish(steps.with_all_rows(found, keys, GAME.counted), GAME, "day", (), rows)


# --- Stored rollups ------------------------------------------------------------


def full_rebuild(spark: SparkSession, sf: str) -> DataFrame:
    target = Target(scratch_path(spark, "game_by_day"), GAME, "day")
    rebuild(session_events(spark, sf), target)
    return target.read(spark)


def target_high_watermark(spark: SparkSession, sf: str) -> DataFrame:
    target = Target(scratch_path(spark, "floor_by_hour"), FLOOR, "hour")
    rebuild(session_events(spark, sf), target)
    return spark.createDataFrame([(target.newest(spark)[None],)], f"{HOUR_BUCKET} string")


def incremental_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """The first half of history, then a refresh that must complete the broken hour."""
    target = Target(scratch_path(spark, "floor_by_hour"), FLOOR, "hour")
    events = session_events(spark, sf)
    refresh(events.filter(F.col("eventTime") < _midway(events)), target)
    refresh(events, target)
    return target.read(spark)


def shared_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """All six rollups in two refreshes; one of them is returned."""
    targets = default_targets(scratch_path(spark, "rollups"))
    events = session_events(spark, sf)
    refresh_all(events.filter(F.col("eventTime") < _midway(events)), targets)
    refresh_all(events, targets)
    return targets["game_by_hour"].read(spark)


# --- Days from hourly states -----------------------------------------------------


def _in_three(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Events up to a third, two thirds, and all of history."""
    events = session_events(spark, sf)
    low, high = events.agg(F.min("eventTime"), F.max("eventTime")).first()
    return [events.filter(F.col("eventTime") < low + (high - low) * k // 3) for k in (1, 2)] + [events]


def _from_states(model: Model) -> Query:
    """A daily rollup from hourly states, both brought up to date in three slices."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        states = state_target(scratch_path(spark, "states"), model)
        days = Target(scratch_path(spark, "days"), model, "day")
        for events in _in_three(spark, sf):
            refresh_days(events, states, days)
        return days.read(spark)

    return query


# --- Time and order ----------------------------------------------------------------


def _measured(model: Measured, grain: str) -> Query:
    return lambda spark, sf: measure(session_events(spark, sf), model, grain)


def _measured_in_slices(model: Measured, grain: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        target = Target(scratch_path(spark, model.name), model, grain)
        for events in _in_three(spark, sf):
            refresh_measured(events, target)
        return target.read(spark)

    return query


# --- Tenants -------------------------------------------------------------------


def _sites(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Each site's events as a source of its own."""
    every = session_events(spark, sf, tenant=True)
    names = [row[0] for row in every.select(TENANT).distinct().collect()]
    own = {n: every.filter(F.col(TENANT) == n).drop(TENANT) for n in names}
    return read_tenants(spark, own, SITES)


def tenant_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return rollups.floor_by_day(union_tenants(_sites(spark, sf)), by=(TENANT,))


def tenant_high_watermark(spark: SparkSession, sf: str) -> DataFrame:
    target = Target(scratch_path(spark, "floor_by_hour"), FLOOR, "hour", by=(TENANT,))
    rebuild(_sites(spark, sf), target)
    newest = [(name, label) for name, label in target.newest(spark).items()]
    return spark.createDataFrame(newest, f"{TENANT} string, {HOUR_BUCKET} string")


def tenant_rebuild(spark: SparkSession, sf: str) -> DataFrame:
    """Full history for all sites, then one site again with the later half of its events."""
    target = Target(scratch_path(spark, "floor_by_day"), FLOOR, "day", by=(TENANT,))
    sites = _sites(spark, sf)
    rebuild(sites, target)
    half = _midway(session_events(spark, sf))
    first = min(sites)
    rebuild({first: sites[first].filter(F.col("eventTime") >= half)}, target)
    return target.read(spark)


def decimal_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Two refreshes over decimal money, read back as whole minor units."""
    target = Target(scratch_path(spark, "floor_by_hour"), FLOOR, "hour")
    events = session_events(spark, sf)
    money = {c: (F.col(c) / 100).cast("decimal(18,2)") for c in MONEY_COLUMNS}
    half = _midway(events)
    refresh(events.withColumns(money).filter(F.col("eventTime") < half), target)
    refresh(events.withColumns(money), target)
    stored = target.read(spark)
    units = [f.name for f in stored.schema if isinstance(f.dataType, T.DecimalType)]
    whole = {c: (F.col(c) * 100).cast("bigint") for c in units if not c.endswith("avg_bet_size")}
    return stored.withColumns(whole).drop("total_avg_bet_size")


def tenant_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Half of history for every tenant but one, then a refresh of them all."""
    target = Target(scratch_path(spark, "floor_by_day"), FLOOR, "day", by=(TENANT,))
    sites = _sites(spark, sf)
    half = _midway(session_events(spark, sf))
    early = {n: df.filter(F.col("eventTime") < half) for n, df in sorted(sites.items())[1:]}
    refresh(early, target)
    refresh(sites, target)
    return target.read(spark)


def queries() -> dict[str, Query]:
    return {
        "player_by_hour": _rollup(PLAYER, "hour"),
        "player_by_day": _rollup(PLAYER, "day"),
        "floor_by_hour": _rollup(FLOOR, "hour"),
        "floor_by_day": _rollup(FLOOR, "day"),
        "game_by_hour": _rollup(GAME, "hour"),
        "game_by_day": _rollup(GAME, "day"),
        "game_by_hour_literal": _rollup(GAME, "hour", null_safe_totals=False),
        "game_by_day_literal": _rollup(GAME, "day", null_safe_totals=False),
        "scan_session_data": session_events,
        "measure_columns": measure_columns,
        "player_type_tag": player_type_tag,
        "hour_bucket": _bucket("hour"),
        "day_bucket": _bucket("day"),
        "filter_updates": _filter(is_update),
        "filter_carded": _filter(is_carded),
        "filter_floor": _filter(lambda: F.col("floorLocation").isNotNull()),
        "filter_asset": _filter(lambda: F.col("assetNumber").isNotNull()),
        "incremental_hour_slice": _slice(FLOOR, "hour"),
        "incremental_day_slice": _slice(PLAYER, "day"),
        "target_high_watermark": target_high_watermark,
        "tenant_high_watermark": tenant_high_watermark,
        "floor_legs": _legs(FLOOR, "hour"),
        "game_legs": _legs(GAME, "hour"),
        "distinct_totals": distinct_totals,
        "floor_totals_join": _totals_join(FLOOR, "hour"),
        "game_totals_join": _totals_join(GAME, "hour"),
        "game_totals_join_literal": _totals_join(GAME, "hour", null_safe=False),
        "floor_all_rows": _all_rows(FLOOR, "hour"),
        "game_all_rows": _all_rows(GAME, "hour"),
        "union_all_legs": union_all_legs,
        "ordered_floor": ordered_floor,
        "net_win": _columns(FLOOR, "hour", "total_net_win"),
        "distinct_counts": _columns(
            FLOOR,
            "hour",
            "total_session_counts",
            "total_distinct_asset_counts",
            "total_distinct_game_themes",
            "total_distinct_player_card_numbers",
        ),
        "weighted_mean": _columns(FLOOR, "hour", "total_avg_bet_size", "avg_duration"),
        "theme_list": _columns(
            PLAYER, "day", "total_spins", "distinct_game_themes", "game_theme_list"
        ),
        "tenant_rollup": tenant_rollup,
        "full_rebuild": full_rebuild,
        "incremental_refresh": incremental_refresh,
        "shared_refresh": shared_refresh,
        "tenant_refresh": tenant_refresh,
        "tenant_rebuild": tenant_rebuild,
        "decimal_refresh": decimal_refresh,
        "player_by_day_from_states": _from_states(PLAYER),
        "floor_by_day_from_states": _from_states(FLOOR),
        "game_by_day_from_states": _from_states(GAME),
        "player_velocity_by_hour": _measured(PLAYER_VELOCITY, "hour"),
        "game_velocity_by_day": _measured(GAME_VELOCITY, "day"),
        "player_velocity_refresh": _measured_in_slices(PLAYER_VELOCITY, "day"),
        "floor_occupancy_by_hour": _measured(FLOOR_OCCUPANCY, "hour"),
        "floor_occupancy_refresh": _measured_in_slices(FLOOR_OCCUPANCY, "hour"),
        "floor_activity_by_hour": _measured(FLOOR_ACTIVITY, "hour"),
        "floor_activity_by_day": _measured(FLOOR_ACTIVITY, "day"),
        "floor_activity_refresh": _measured_in_slices(FLOOR_ACTIVITY, "hour"),
        "player_budgets_by_day": _measured(PLAYER_BUDGETS, "day"),
        "player_budgets_refresh": _measured_in_slices(PLAYER_BUDGETS, "hour"),
    }
