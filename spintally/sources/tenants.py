"""Many databases in one job: each tenant's events, tagged with its name."""

from __future__ import annotations

import re
from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spintally.sources.sessions import read_sessions

TENANT = "tenant"


def matching(names: Collection[str], pattern: str) -> list[str]:
    """Names that an SQL ``ILIKE`` pattern matches (``%`` any text, ``_`` one character)."""
    wild = {"%": ".*", "_": "."}
    regex = "".join(wild.get(ch, re.escape(ch)) for ch in pattern)
    return [n for n in names if re.fullmatch(regex, n, re.IGNORECASE | re.DOTALL)]


def read_tenants(
    spark: SparkSession,
    sources: Mapping[str, str | DataFrame],
    pattern: str = "%",
    only: Collection[str] | None = None,
) -> dict[str, DataFrame]:
    """Events per tenant, for every name that ``pattern`` matches.

    A source is a location or a DataFrame. ``only`` names a subset, to run again
    the tenants whose sources failed.
    """
    chosen = [n for n in matching(sources, pattern) if only is None or n in only]
    frames = {}
    for name in chosen:
        source = sources[name]
        events = source if isinstance(source, DataFrame) else read_sessions(spark, source)
        frames[name] = events.withColumn(TENANT, F.lit(name))
    return frames


def union_tenants(frames: Mapping[str, DataFrame]) -> DataFrame:
    """All tenants as one DataFrame, so one job serves them all.

    Halves are put together, so that no plan is analysed once per tenant.
    """
    if not frames:
        raise ValueError("no tenant matched")
    parts = list(frames.values())
    while len(parts) > 1:
        pairs = [parts[i : i + 2] for i in range(0, len(parts), 2)]
        parts = [pair[0].unionByName(pair[1]) if len(pair) == 2 else pair[0] for pair in pairs]
    return parts[0]
