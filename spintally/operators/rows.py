"""From raw events to the rows that rollups group.

A row has a bucket number, the dimensions under their output names, the player
type and the foldable measure parts. One event makes one row; :func:`compact`
folds the rows of one session in one bucket into one. Both kinds group alike.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spintally.functions.buckets import UTC, bucket_number, day_of_hour
from spintally.functions.measures import event_parts, fold_parts, player_type
from spintally.schema import UPDATE_EVENT

BUCKET = "bucket"
PLAYER_TYPE = "player_type"

# Output name of each dimension and the raw column it comes from.
DIMENSIONS = {
    "player_card_number": "playerCardNumber",
    "asset_number": "assetNumber",
    "ess": "ess",
    "game_id": "gameId",
    "game_name": "devInfoGameTheme",
    "floor_location": "floorLocation",
    "session_uuid": "sessionUuid",
}


def is_update() -> Column:
    return F.col("type") == UPDATE_EVENT


def is_carded(column: str = "playerCardNumber") -> Column:
    """True for a card number with text; NULL cards compare to NULL and drop out."""
    return F.col(column) != ""


def event_rows(
    events: DataFrame, grain: str, tz: str = UTC, by: tuple[str, ...] = ()
) -> DataFrame:
    """Update events only, one row each, with the ``by`` columns passed through."""
    return events.filter(is_update()).select(
        bucket_number(F.col("eventTime"), grain, tz).alias(BUCKET),
        *by,
        *(F.col(raw).alias(name) for name, raw in DIMENSIONS.items()),
        player_type(F.col("playerCardNumber")).alias(PLAYER_TYPE),
        *event_parts(),
    )


def compact(
    rows: DataFrame, by: tuple[str, ...] = (), dimensions: Iterable[str] = tuple(DIMENSIONS)
) -> DataFrame:
    """One row per bucket and combination of the dimensions.

    Plays of one session on one machine in one hour become a single row. Distinct
    counts over the kept dimensions do not change.
    """
    return rows.groupBy(BUCKET, *by, *dimensions, PLAYER_TYPE).agg(*fold_parts())


def to_days(hour_rows: DataFrame) -> DataFrame:
    """Hour rows as day rows."""
    return hour_rows.withColumn(BUCKET, day_of_hour(F.col(BUCKET)))
