"""Hand-made session events for tests."""

from __future__ import annotations

from pyspark.sql import types as T

from spintally.schema import MONEY_COLUMNS, session_schema

HOUR = 3_600_000
DAY = 24 * HOUR
NOON = 1_704_110_400_000  # 2024-01-01 12:00:00 UTC


def event(at: int = NOON, card: str | None = "P1", **changes) -> dict:
    """One update event worth a wager of 100; keyword arguments change columns."""
    columns = {
        "eventTime": at,
        "type": "STUpdate",
        "playerCardNumber": card,
        "assetNumber": "A1",
        "ess": "E1",
        "gameId": "G1",
        "devInfoGameTheme": "Theme",
        "floorLocation": "0101",
        "sessionUuid": "S1",
        **dict.fromkeys(MONEY_COLUMNS, 0),
        "updateCashableWager": 100,
        "maxCashableRisked": 500,
        "duration": 10,
    }
    unknown = set(changes) - set(columns) - {"tenant"}
    assert not unknown, unknown
    return columns | changes


def table(spark, events: list[dict], money: T.DataType = T.LongType()):
    fields = list(session_schema(money))
    if any("tenant" in e for e in events):
        fields.append(T.StructField("tenant", T.StringType()))
    schema = T.StructType(fields)
    return spark.createDataFrame([tuple(e[n] for n in schema.names) for e in events], schema)


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def by_type(df) -> dict:
    """Rows of a one-group split rollup by player type."""
    found = df.collect()
    assert len({r.player_type for r in found}) == len(found)
    return {r.player_type: r for r in found}
