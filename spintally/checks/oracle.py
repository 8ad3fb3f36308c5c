"""DuckDB SQL for every registered query, put together independently of the plans.

Each statement works the slow, plain way: legs, whole-group distinct counts, a
join and a union, from formatted text buckets. Nothing here is shared with the
Spark side but the fixture's columns.
"""

from __future__ import annotations

from spintally.checks.fixture import session_events_sql

_LABEL = {
    "hour": "strftime(make_timestamp(eventTime * 1000), '%Y-%m-%d %H:00:00')",
    "day": "strftime(make_timestamp(eventTime * 1000), '%Y-%m-%d 00:00:00')",
}
_KEYS = {
    "player": ["player_card_number"],
    "floor": ["floor_location"],
    "game": ["asset_number", "ess", "game_id", "game_name"],
}
_KEEP = {
    "player": "player_card_number <> ''",
    "floor": "floor_location IS NOT NULL",
    "game": "asset_number IS NOT NULL",
}
_RAW = (
    "eventTime, type, playerCardNumber, assetNumber, ess, gameId, devInfoGameTheme, floorLocation,"
    " sessionUuid, updateCashableWager, updateRestrictedWager, updateOORVCashableWager,"
    " updateOORVRestrictedWager, updateWon, updateOORVWon, updateJackpot, updateOORVJackpot,"
    " maxCashableRisked, duration"
)
_MONEY = """updateCashableWager + updateOORVCashableWager AS cashable,
    updateCashableWager + updateRestrictedWager
      + updateOORVCashableWager + updateOORVRestrictedWager AS wagered,
    updateWon + updateOORVWon AS paid,
    updateJackpot + updateOORVJackpot AS hit,
    maxCashableRisked AS budget"""
_TAG = "CASE WHEN coalesce(playerCardNumber, '') = '' THEN 'uncarded' ELSE 'carded' END"


def _big(total: str, name: str) -> str:
    return f"CAST({total} AS BIGINT) AS {name}"


def _ratio(total: str, count: str, name: str) -> str:
    return f"CAST({total} AS DOUBLE) / nullif({count}, 0) AS {name}"


_SUMS = [
    _big("sum(wagered)", "total_coin_in"),
    _big("sum(cashable)", "total_cashable_coin_in"),
    _big("sum(paid)", "total_coin_out"),
    _big("sum(hit)", "total_jackpot"),
    _big("sum(wagered) - sum(paid) - sum(hit)", "total_net_win"),
    "max(budget) AS max_player_budget",
    "count(*) AS total_spins",
    _big("sum(duration)", "total_duration"),
    _ratio("sum(duration)", "count(duration)", "avg_duration"),
]
_DISTINCT = [
    "count(DISTINCT sessionUuid) AS total_session_counts",
    "count(DISTINCT asset_number) AS total_distinct_asset_counts",
    "count(DISTINCT game_name) AS total_distinct_game_themes",
    "count(DISTINCT player_card_number) AS total_distinct_player_card_numbers",
]
_DISTINCT_NAMES = [d.rsplit(" ", 1)[1] for d in _DISTINCT]
_RESUMMED = [
    _big(f"sum({name})", name)
    for name in (
        "total_coin_in",
        "total_cashable_coin_in",
        "total_coin_out",
        "total_jackpot",
        "total_net_win",
        "total_spins",
        "total_duration",
    )
] + ["max(max_player_budget) AS max_player_budget"]
_WEIGHTED = [
    _ratio("total_coin_in", "total_spins", "total_avg_bet_size"),
    _ratio("total_duration", "total_spins", "avg_duration"),
]


def _select(*parts: list[str] | str) -> str:
    flat = [x for part in parts for x in ([part] if isinstance(part, str) else part)]
    return ",\n    ".join(flat)


class _Sql:
    """The steps of one rollup as common table expressions, by name."""

    def __init__(self, model: str, grain: str, null_safe: bool = True, tenant: bool = False):
        self.bucket = f"{grain}_bucket"
        self.keys = (["tenant"] if tenant else []) + [self.bucket, *_KEYS[model]]
        listed = ", ".join(self.keys)
        equal = "IS NOT DISTINCT FROM" if null_safe else "="
        on = " AND ".join(f"f.{k} {equal} w.{k}" for k in self.keys)
        counts = ", ".join(f"w.{name}" for name in _DISTINCT_NAMES)
        self.steps = {
            "src": session_events_sql(),
            "plays": f"""SELECT tenant, {_LABEL[grain]} AS {self.bucket},
    playerCardNumber AS player_card_number, assetNumber AS asset_number, ess,
    gameId AS game_id, devInfoGameTheme AS game_name, floorLocation AS floor_location,
    {_TAG} AS player_type, sessionUuid, duration,
    {_MONEY}
  FROM src WHERE type = 'STUpdate'""",
            "kept": f"SELECT * FROM plays WHERE {_KEEP[model]}",
            "legs": "SELECT "
            + _select(
                self.keys,
                "player_type",
                _SUMS,
                _ratio("sum(wagered)", "count(wagered)", "total_avg_bet_size"),
                _DISTINCT,
            )
            + f"\n  FROM kept GROUP BY {listed}, player_type",
            "wholes": f"SELECT {_select(self.keys, _DISTINCT)}\n  FROM kept GROUP BY {listed}",
            "folded": f"SELECT {_select(self.keys, _RESUMMED)}\n  FROM legs GROUP BY {listed}",
            "joined": f"SELECT f.*, {counts} FROM folded f JOIN wholes w ON {on}",
            "alls": "SELECT " + _select("*", "'All' AS player_type", _WEIGHTED) + "\n  FROM joined",
            "combined": "SELECT * FROM legs UNION ALL BY NAME SELECT * FROM alls",
        }

    def query(self, last: str, *only: str) -> str:
        chosen = {name: self.steps[name] for name in only or self.steps}
        steps = ",\n".join(f"{name} AS (\n  {sql}\n)" for name, sql in chosen.items())
        return f"WITH {steps}\n{last}"


def _split(model: str, grain: str, last: str = "SELECT * FROM combined", **options) -> str:
    return _Sql(model, grain, **options).query(last)


def _player(grain: str, columns: list[str] | None = None) -> str:
    sql = _Sql("player", grain)
    bet = _ratio("sum(wagered)", "count(wagered)", "avg_bet_size")
    themes = [
        "count(DISTINCT game_name) AS distinct_game_themes",
        "string_agg(DISTINCT game_name, ', ' ORDER BY game_name) AS game_theme_list",
    ]
    picked = columns or [*_SUMS, bet, *_DISTINCT[:2]]
    chosen = _select(sql.keys, picked, themes)
    last = f"SELECT {chosen}\nFROM kept GROUP BY {', '.join(sql.keys)}"
    return sql.query(last, "src", "plays", "kept")


def _src(last: str) -> str:
    return f"WITH src AS (\n  {session_events_sql()}\n)\n{last}"


_MIDWAY = "(SELECT (min(eventTime) + max(eventTime)) // 2 FROM src)"


def _slice(model: str, grain: str) -> str:
    label = _LABEL[grain]
    keep = {"floor": "floorLocation IS NOT NULL", "player": "playerCardNumber <> ''"}[model]
    return _src(
        f"SELECT {_RAW} FROM src WHERE {label} >= (\n  SELECT max({label}) FROM src"
        f"\n  WHERE type = 'STUpdate' AND {keep} AND eventTime < {_MIDWAY}\n)"
    )


def _later_half_of_first(sql: _Sql) -> str:
    first = "(SELECT min(tenant) FROM src)"
    sql.steps["plays"] += f" AND (tenant <> {first} OR eventTime >= {_MIDWAY})"
    return sql.query("SELECT * FROM combined")


_WIDTH = {"hour": 3_600_000, "day": 86_400_000}


def _number_label(grain: str, number: str = "number") -> str:
    return f"strftime(make_timestamp({number} * {_WIDTH[grain]} * 1000), '%Y-%m-%d %H:00:00') AS {grain}_bucket"


def _timed(model: str, last: str) -> str:
    """SQL over ``kept``, the model's plays with their keys and time."""
    keys = ", ".join(_KEYS[model])
    return _src("").rstrip() + f""", plays AS (
  SELECT playerCardNumber AS player_card_number, assetNumber AS asset_number, ess, gameId AS game_id,
    devInfoGameTheme AS game_name, floorLocation AS floor_location, eventTime AS play_time, duration, maxCashableRisked AS budget
  FROM src WHERE type = 'STUpdate'
), kept AS (
  SELECT {keys}, play_time, duration, budget{"" if "game_name" in keys else ", game_name"} FROM plays WHERE {_KEEP[model]}
)
{last}"""


def _velocity(model: str, grain: str) -> str:
    keys = ", ".join(_KEYS[model])
    return _timed(model, f"""SELECT {_number_label(grain, f"(play_time // {_WIDTH[grain]})")}, {keys},
  count(*) AS total_spins, count(gap) AS timed_plays, CAST(coalesce(sum(gap), 0) AS BIGINT) AS total_gap_ms,
  {_ratio("sum(gap)", "count(gap)", "avg_gap_ms")}, min(gap) AS shortest_gap_ms, max(gap) AS longest_gap_ms, max(play_time) AS last_play_ms
FROM (SELECT *, play_time - lag(play_time) OVER (PARTITION BY {keys} ORDER BY play_time) AS gap FROM kept) GROUP BY ALL""")


def _occupancy(model: str, grain: str) -> str:
    keys, width = ", ".join(_KEYS[model]), _WIDTH[grain]
    return _timed(model, f"""SELECT {_number_label(grain)}, {keys}, CAST(sum(new) AS BIGINT) AS occupied_ms,
  CAST(100 * sum(new) AS DOUBLE) / {width} AS occupancy_pct, max(stop) AS busy_until_ms
FROM (
  SELECT *, greatest(0, till - greatest(since, coalesce(max(till) OVER (
    PARTITION BY {keys}, number ORDER BY since, till ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), since))) AS new
  FROM (
    SELECT *, greatest(play_time, number * {width}) AS since, least(stop, (number + 1) * {width}) AS till
    FROM (SELECT *, play_time + duration * 1000 AS stop FROM kept WHERE duration > 0), unnest(range(play_time // {width}, (stop - 1) // {width} + 1)) AS r(number)
  )
) WHERE number <= (SELECT max(play_time) // {width} FROM kept WHERE duration > 0) GROUP BY ALL""")


def _activity(model: str, grain: str, idle: int = 900_000) -> str:
    keys, width = ", ".join(_KEYS[model]), _WIDTH[grain]
    using = f"USING (number, {keys})"
    return _timed(model, f""", marked AS (
  SELECT *, coalesce(play_time - lag(play_time) OVER w > {idle}, true) AS opens FROM kept WINDOW w AS (PARTITION BY {keys} ORDER BY play_time)
), numbered AS (
  SELECT *, sum(CAST(opens AS INT)) OVER (PARTITION BY {keys} ORDER BY play_time, opens DESC ROWS UNBOUNDED PRECEDING) AS spell FROM marked
), spells AS (
  SELECT {keys}, spell, min(play_time) AS since, max(play_time) + {idle} AS till FROM numbered GROUP BY ALL
), active AS (
  SELECT {keys}, number, CAST(sum(least(till, (number + 1) * {width}) - greatest(since, number * {width})) AS BIGINT) AS active_ms,
    bool_or(till >= (number + 1) * {width}) AS active_at_end
  FROM spells, unnest(range(since // {width}, (till - 1) // {width} + 1)) AS r(number) GROUP BY ALL
), played AS (
  SELECT play_time // {width} AS number, {keys}, count(*) AS total_spins, count(*) FILTER (opens) AS spells_started, max(play_time) AS last_play_ms
  FROM marked GROUP BY ALL
)
SELECT {_number_label(grain)}, {keys}, coalesce(total_spins, 0) AS total_spins, coalesce(spells_started, 0) AS spells_started,
  active_ms, CAST(100 * active_ms AS DOUBLE) / {width} AS active_pct, active_at_end, last_play_ms
FROM active LEFT JOIN played {using} WHERE number <= (SELECT max(play_time) // {width} FROM kept)""").replace("\n)\n, marked", "\n), marked")


def _budgets(grain: str) -> str:
    label = _number_label(grain, f"(play_time // {_WIDTH[grain]})")
    return _timed("player", f"""SELECT {grain}_bucket, player_card_number, count(*) AS games, max(budget) AS max_player_budget,
  string_agg(game_name || '=' || CAST(budget AS VARCHAR), ', ' ORDER BY game_name) AS max_budget_by_game
FROM (
  SELECT {label}, player_card_number, game_name, max(budget) AS budget FROM kept
  WHERE game_name IS NOT NULL AND budget IS NOT NULL GROUP BY ALL
) GROUP BY ALL""")


_SPLIT_KEYS = "hour_bucket, floor_location, player_type"


def oracle_sql() -> dict[str, str]:
    """SQL by query name; column order is free, names and types are not."""
    legs, alls = "SELECT * FROM legs", "SELECT * FROM alls"
    joined = "SELECT * FROM joined"
    return {
        "player_by_hour": _player("hour"),
        "player_by_day": _player("day"),
        "floor_by_hour": _split("floor", "hour"),
        "floor_by_day": _split("floor", "day"),
        "game_by_hour": _split("game", "hour"),
        "game_by_day": _split("game", "day"),
        "game_by_hour_literal": _split("game", "hour", null_safe=False),
        "game_by_day_literal": _split("game", "day", null_safe=False),
        "scan_session_data": _src(f"SELECT {_RAW} FROM src"),
        "measure_columns": _src(
            "SELECT eventTime, sessionUuid, wagered AS coin_in, cashable AS cashable_coin_in,"
            " paid AS coin_out, hit AS jackpot, budget FROM ("
            f"\n  SELECT eventTime, sessionUuid, type, {_MONEY} FROM src\n) WHERE type = 'STUpdate'"
        ),
        "player_type_tag": _src(f"SELECT eventTime, playerCardNumber, {_TAG} AS player_type FROM src"),
        "hour_bucket": _src(f"SELECT eventTime, {_LABEL['hour']} AS hour_bucket FROM src"),
        "day_bucket": _src(f"SELECT eventTime, {_LABEL['day']} AS day_bucket FROM src"),
        "filter_updates": _src(f"SELECT {_RAW} FROM src WHERE type = 'STUpdate'"),
        "filter_carded": _src(f"SELECT {_RAW} FROM src WHERE playerCardNumber <> ''"),
        "filter_floor": _src(f"SELECT {_RAW} FROM src WHERE floorLocation IS NOT NULL"),
        "filter_asset": _src(f"SELECT {_RAW} FROM src WHERE assetNumber IS NOT NULL"),
        "incremental_hour_slice": _slice("floor", "hour"),
        "incremental_day_slice": _slice("player", "day"),
        "target_high_watermark": _split(
            "floor", "hour", "SELECT max(hour_bucket) AS hour_bucket FROM combined"
        ),
        "tenant_high_watermark": _split(
            "floor",
            "hour",
            "SELECT tenant, max(hour_bucket) AS hour_bucket FROM combined GROUP BY tenant",
            tenant=True,
        ),
        "floor_legs": _split("floor", "hour", legs),
        "game_legs": _split("game", "hour", legs),
        "distinct_totals": _split("floor", "hour", "SELECT * FROM wholes"),
        "floor_totals_join": _split("floor", "hour", joined),
        "game_totals_join": _split("game", "hour", joined),
        "game_totals_join_literal": _split("game", "hour", joined, null_safe=False),
        "floor_all_rows": _split("floor", "hour", alls),
        "game_all_rows": _split("game", "hour", alls),
        "union_all_legs": _split("game", "day"),
        "ordered_floor": _split("floor", "hour", "SELECT * FROM combined ORDER BY hour_bucket"),
        "net_win": _split(
            "floor", "hour", f"SELECT {_SPLIT_KEYS}, total_net_win FROM combined"
        ),
        "distinct_counts": _split(
            "floor", "hour", f"SELECT {_SPLIT_KEYS}, {', '.join(_DISTINCT_NAMES)} FROM combined"
        ),
        "weighted_mean": _split(
            "floor",
            "hour",
            f"SELECT {_SPLIT_KEYS}, total_avg_bet_size, avg_duration FROM combined",
        ),
        "theme_list": _player("day", columns=["count(*) AS total_spins"]),
        "tenant_rollup": _split("floor", "day", tenant=True),
        "full_rebuild": _split("game", "day"),
        "incremental_refresh": _split("floor", "hour"),
        "shared_refresh": _split("game", "hour"),
        "tenant_refresh": _split("floor", "day", tenant=True),
        "tenant_rebuild": _later_half_of_first(_Sql("floor", "day", tenant=True)),
        "decimal_refresh": _split(
            "floor", "hour", "SELECT * EXCLUDE (total_avg_bet_size) FROM combined"
        ),
        "player_by_day_from_states": _player("day"),
        "floor_by_day_from_states": _split("floor", "day"),
        "game_by_day_from_states": _split("game", "day"),
        "player_velocity_by_hour": _velocity("player", "hour"),
        "game_velocity_by_day": _velocity("game", "day"),
        "player_velocity_refresh": _velocity("player", "day"),
        "floor_occupancy_by_hour": _occupancy("floor", "hour"),
        "floor_occupancy_refresh": _occupancy("floor", "hour"),
        "floor_activity_by_hour": _activity("floor", "hour"),
        "floor_activity_by_day": _activity("floor", "day"),
        "floor_activity_refresh": _activity("floor", "hour"),
        "player_budgets_by_day": _budgets("day"),
        "player_budgets_refresh": _budgets("hour"),
    }
