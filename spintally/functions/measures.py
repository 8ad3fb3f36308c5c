"""Money and play measures, from one event up to a finished group.

A group's measures are carried as *parts* that fold: sums, counts and one
maximum. Folding parts of parts gives the same parts, so an event, a
pre-aggregated session-hour and a whole group have the same columns, and means
and net win are worked out only at the end.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spintally.schema import (
    BUDGET_COLUMN,
    CARDED,
    CASHABLE_WAGER_COLUMNS,
    JACKPOT_COLUMNS,
    PAYOUT_COLUMNS,
    THEME_SEPARATOR,
    UNCARDED,
    WAGER_COLUMNS,
)

SUMMED_PARTS = (
    "spins",
    "coin_in",
    "coin_in_known",
    "cashable_coin_in",
    "coin_out",
    "jackpot",
    "duration",
    "duration_known",
)
PARTS = (*SUMMED_PARTS, "budget")


def total_of(columns: tuple[str, ...]) -> Column:
    """Sum across columns of one row; NULL if any of them is NULL."""
    return reduce(add, map(F.col, columns))


def event_measures() -> list[Column]:
    """The five money columns of one event."""
    return [
        total_of(WAGER_COLUMNS).alias("coin_in"),
        total_of(CASHABLE_WAGER_COLUMNS).alias("cashable_coin_in"),
        total_of(PAYOUT_COLUMNS).alias("coin_out"),
        total_of(JACKPOT_COLUMNS).alias("jackpot"),
        F.col(BUDGET_COLUMN).alias("budget"),
    ]


def event_parts() -> list[Column]:
    """One event seen as a group of size one."""
    return [
        F.lit(1).cast("bigint").alias("spins"),
        *event_measures(),
        total_of(WAGER_COLUMNS).isNotNull().cast("bigint").alias("coin_in_known"),
        F.col("duration"),
        F.col("duration").isNotNull().cast("bigint").alias("duration_known"),
    ]


def fold_parts() -> list[Column]:
    """Aggregates that merge parts into the same parts of a larger group."""
    return [*(F.sum(p).alias(p) for p in SUMMED_PARTS), F.max("budget").alias("budget")]


def net_win(prefix: str = "") -> Column:
    """Wagers less payouts and jackpots; NULL if any of the three sums is NULL."""
    wagered, paid, hit = (F.col(prefix + part) for part in ("coin_in", "coin_out", "jackpot"))
    return wagered - paid - hit


def mean(total: Column, count: Column, of: T.DataType) -> Column:
    """``total / count``, NULL for no rows.

    Whole-number totals are exact until the one division, so the result does
    not depend on row order. Decimals keep four more digits, as ``avg`` does.
    """
    count = F.nullif(count, F.lit(0))
    if isinstance(of, T.DecimalType):
        digits = T.DecimalType(min(38, of.precision + 4), min(38, of.scale + 4))
        return (total / count).cast(digits)
    return total.cast("double") / count


def sum_type(of: T.DataType) -> T.DataType:
    """Type of ``sum`` over a column, however many levels it was summed in."""
    if isinstance(of, T.DecimalType):
        return T.DecimalType(min(38, of.precision + 10), of.scale)
    return T.LongType()


def player_type(card: Column) -> Column:
    """``carded`` for a card number with text in it, else ``uncarded``."""
    return F.when(card.isNull() | (card == ""), UNCARDED).otherwise(CARDED)


def joined_themes(themes: Column) -> Column:
    """One text from an array of distinct themes, in byte order; NULL for none."""
    return F.when(F.size(themes) > 0, F.array_join(F.array_sort(themes), THEME_SEPARATOR))
