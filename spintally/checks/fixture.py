"""Session events worked out from the ``events`` test table.

The column expressions read the same to Spark and to DuckDB, apart from the
conversion of ``ts`` to epoch milliseconds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spintally.sources.sessions import conform

SPARK_MILLIS = "unix_millis(CAST(ts AS TIMESTAMP))"
DUCKDB_MILLIS = "epoch_us(ts) // 1000"

_COLUMNS = {
    "type": "CASE WHEN event_type = 'error' THEN 'STEnd' ELSE 'STUpdate' END",
    "playerCardNumber": "CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_id % 10 < 4 THEN ''"
    " ELSE concat('P', CAST(user_id AS STRING)) END",
    "assetNumber": "CASE WHEN event_id % 53 = 0 THEN NULL"
    " ELSE concat('A', CAST(event_id % 3 AS STRING)) END",
    "ess": "CASE WHEN event_id % 41 = 0 THEN NULL"
    " ELSE concat('E', CAST(event_id % 3 AS STRING)) END",
    "gameId": "CASE WHEN event_id % 47 = 0 THEN NULL"
    " ELSE concat('G', CAST(event_id % 3 AS STRING)) END",
    "devInfoGameTheme": "CASE WHEN event_id % 43 = 0 THEN NULL"
    " ELSE concat('Theme ', CAST(event_id % 6 AS STRING)) END",
    "floorLocation": "CASE WHEN event_id % 59 = 0 THEN NULL"
    " ELSE concat('010', CAST(event_id % 4 AS STRING)) END",
    "sessionUuid": "concat('S', CAST(user_id AS STRING), '-', CAST(event_id % 5 AS STRING))",
    "updateCashableWager": "CASE WHEN event_id % 61 = 0 THEN NULL"
    " ELSE CAST(round(value * 100) AS BIGINT) END",
    "updateRestrictedWager": "CAST(CASE WHEN event_id % 7 = 0 THEN 25 ELSE 0 END AS BIGINT)",
    "updateOORVCashableWager": "CAST(CASE WHEN event_id % 11 = 0 THEN 100 ELSE 0 END AS BIGINT)",
    "updateOORVRestrictedWager": "CAST(CASE WHEN event_id % 13 = 0 THEN 50 ELSE 0 END AS BIGINT)",
    "updateWon": "CASE WHEN event_type = 'purchase' THEN CAST(round(value * 200) AS BIGINT)"
    " ELSE CAST(0 AS BIGINT) END",
    "updateOORVWon": "CAST(CASE WHEN event_id % 17 = 0 THEN 75 ELSE 0 END AS BIGINT)",
    "updateJackpot": "CAST(CASE WHEN event_id % 101 = 0 THEN 100000 ELSE 0 END AS BIGINT)",
    "updateOORVJackpot": "CAST(CASE WHEN event_id % 211 = 0 THEN 50000 ELSE 0 END AS BIGINT)",
    "maxCashableRisked": "CAST(round(value * 100) AS BIGINT) + 500 * (event_id % 5)",
    "duration": "CASE WHEN event_id % 67 = 0 THEN NULL ELSE event_id % 45 + 1 END",
}

# Five sites in one job, each with its own part of the table.
TENANT_NAME = "concat('site_', event_type)"


def session_events(spark: SparkSession, sf_dir: str, tenant: bool = False) -> DataFrame:
    """All of ``events`` as session events, optionally with a tenant column."""
    raw = spark.read.parquet(f"{sf_dir}/events.parquet")
    named = {"eventTime": SPARK_MILLIS, **_COLUMNS}
    extra = {"tenant": TENANT_NAME} if tenant else {}
    derived = raw.select(*(F.expr(e).alias(name) for name, e in (named | extra).items()))
    return conform(derived, tuple(extra))


def session_events_sql() -> str:
    """The same table for DuckDB, with the tenant column."""
    named = {"eventTime": DUCKDB_MILLIS, **_COLUMNS, "tenant": TENANT_NAME}
    columns = ",\n  ".join(f"{expr} AS {name}" for name, expr in named.items())
    return f"SELECT\n  {columns}\nFROM events"
