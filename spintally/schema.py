"""The data contract: raw session events in, rollup tables out.

Nothing is inferred at run time. The raw schema, the names and order of every
output column and the handful of literal values the rollups depend on are
stated here once; the rest of the package refers to them.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: names, labels and formats that callers rely on ------------

UPDATE_EVENT = "STUpdate"
CARDED = "carded"
UNCARDED = "uncarded"
ALL_PLAYERS = "All"
THEME_SEPARATOR = ", "

HOUR_BUCKET = "hour_bucket"  # text such as 2024-01-31 17:00:00
DAY_BUCKET = "day_bucket"  # text such as 2024-01-31 00:00:00

SESSION_TABLE = "session_data"
FLOOR_TABLE = "mc_sessions"

WAGER_COLUMNS = (
    "updateCashableWager",
    "updateRestrictedWager",
    "updateOORVCashableWager",
    "updateOORVRestrictedWager",
)
CASHABLE_WAGER_COLUMNS = ("updateCashableWager", "updateOORVCashableWager")
PAYOUT_COLUMNS = ("updateWon", "updateOORVWon")
JACKPOT_COLUMNS = ("updateJackpot", "updateOORVJackpot")
BUDGET_COLUMN = "maxCashableRisked"

PLAYER_MEASURES = (
    "total_coin_in",
    "total_cashable_coin_in",
    "total_coin_out",
    "total_jackpot",
    "total_net_win",
    "max_player_budget",
    "avg_bet_size",
    "total_spins",
    "total_session_counts",
    "total_distinct_asset_counts",
    "total_duration",
    "avg_duration",
    "distinct_game_themes",
    "game_theme_list",
)
SPLIT_MEASURES = (
    "total_coin_in",
    "total_cashable_coin_in",
    "total_coin_out",
    "total_jackpot",
    "total_net_win",
    "max_player_budget",
    "total_avg_bet_size",
    "total_spins",
    "total_session_counts",
    "total_distinct_asset_counts",
    "total_distinct_game_themes",
    "total_distinct_player_card_numbers",
    "total_duration",
    "avg_duration",
)

PLAYER_KEYS = ("player_card_number",)
FLOOR_KEYS = ("floor_location",)
GAME_KEYS = ("asset_number", "ess", "game_id", "game_name")

# --- Raw events --------------------------------------------------------------

_TEXT = (
    "playerCardNumber",
    "assetNumber",
    "ess",
    "gameId",
    "devInfoGameTheme",
    "floorLocation",
    "sessionUuid",
)
MONEY_COLUMNS = (*WAGER_COLUMNS, *PAYOUT_COLUMNS, *JACKPOT_COLUMNS, BUDGET_COLUMN)


def session_schema(money: T.DataType = T.LongType()) -> T.StructType:
    """Schema of one raw event; money is whole minor units unless told otherwise."""
    return T.StructType(
        [
            T.StructField("eventTime", T.LongType(), False),  # epoch milliseconds
            T.StructField("type", T.StringType(), False),
            *(T.StructField(name, T.StringType()) for name in _TEXT),
            *(T.StructField(name, money) for name in MONEY_COLUMNS),
            T.StructField("duration", T.LongType()),
        ]
    )


SESSION_SCHEMA = session_schema()


def bucket_column(grain: str) -> str:
    """Name of the bucket column of an ``hour`` or ``day`` rollup."""
    try:
        return {"hour": HOUR_BUCKET, "day": DAY_BUCKET}[grain]
    except KeyError:
        raise ValueError(f"grain must be 'hour' or 'day', not {grain!r}") from None
