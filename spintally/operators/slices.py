"""Incremental slices: the newest stored bucket and the events from it onward."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spintally.functions.buckets import UTC, bucket_number, earliest_event_time, parse_label


def newest_buckets(stored: DataFrame, bucket: str, *by: str) -> DataFrame:
    """Newest bucket label per ``by`` group, or overall.

    Labels are zero-padded, so the greatest text is the latest time.
    """
    return stored.groupBy(*by).agg(F.max(bucket).alias(bucket))


def high_watermark(stored: DataFrame | None, bucket: str) -> str | None:
    """Newest stored label, None when nothing is stored.

    Runs at once, since the refresh that follows overwrites what is read here.
    """
    return None if stored is None else newest_buckets(stored, bucket).first()[0]


def tenant_watermarks(stored: DataFrame | None, bucket: str, key: str) -> dict[str, str]:
    """Newest stored label of each tenant: one short row per tenant."""
    if stored is None:
        return {}
    return {row[key]: row[bucket] for row in newest_buckets(stored, bucket, key).collect()}


def since_slice(
    events: DataFrame,
    since: str | None,
    grain: str,
    tz: str = UTC,
    lookback: int = 0,
) -> DataFrame:
    """Events at or after the start of bucket ``since``; all of them for None.

    ``lookback`` moves the start back by whole buckets, to take in late events.
    The bound is a plain comparison on the raw column, which the Parquet scan can
    use to skip row groups. Zones with clock changes also compare buckets, since
    there the bound is only a safe one.
    """
    if since is None:
        return events
    first = parse_label(since, grain, back=lookback)
    sliced = events.filter(F.col("eventTime") >= earliest_event_time(first, grain, tz))
    if tz != UTC:
        sliced = sliced.filter(bucket_number(F.col("eventTime"), grain, tz) >= first)
    return sliced
