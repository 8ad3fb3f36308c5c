"""Hour and day buckets.

A bucket is text in the output, but inside a plan it is a whole number: hours
or days of wall-clock time since 1970. Eight-byte keys are cheaper to hash,
shuffle and compare than formatted text, and the text is then made once per
output row instead of once per event. The numbers count wall-clock time, so the
two passes through a repeated hour at a clock change share one bucket, just as
they share one label. Nothing here depends on the session time zone.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

UTC = "UTC"
_EPOCH = datetime(1970, 1, 1)
_WIDTH = {"hour": timedelta(hours=1), "day": timedelta(days=1)}


def _whole(value: Column, width: int) -> Column:
    """Floor division on longs, also right for times before 1970."""
    return F.call_function("div", value - F.pmod(value, F.lit(width)), F.lit(width))


def bucket_number(event_time: Column, grain: str, tz: str = UTC) -> Column:
    """Whole hours or days of wall-clock time in ``tz`` for an epoch-ms column."""
    width_ms = _WIDTH[grain] // timedelta(milliseconds=1)
    if tz == UTC:
        return _whole(event_time, width_ms)
    local = F.from_utc_timestamp(F.timestamp_millis(event_time), tz)
    return _whole(F.unix_millis(local), width_ms)


def bucket_label(number: Column, grain: str) -> Column:
    """Text of a bucket number, ``yyyy-MM-dd HH:00:00`` (hour 00 for days)."""
    unit = F.expr(f"INTERVAL '1' {grain.upper()}")
    start = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    return (start + number * unit).cast("string")


def day_of_hour(hour_number: Column) -> Column:
    """Day number that an hour number falls in."""
    return _whole(hour_number, 24)


def parse_label(label: str, grain: str, back: int = 0) -> int:
    """Bucket number of a label, moved ``back`` whole buckets."""
    return (datetime.fromisoformat(label) - _EPOCH) // _WIDTH[grain] - back


def format_label(number: int, grain: str) -> str:
    """Label of a bucket number, for use outside a plan."""
    return str(_EPOCH + number * _WIDTH[grain])


def earliest_event_time(number: int, grain: str, tz: str = UTC) -> int:
    """Epoch ms that no event of this bucket, or of a later one, can precede.

    Equal to the bucket's first millisecond except around clock changes, where
    the earlier of the two readings is taken.
    """
    wall = _EPOCH + number * _WIDTH[grain]
    zone = timezone.utc if tz == UTC else ZoneInfo(tz)
    readings = (wall.replace(tzinfo=zone, fold=fold) for fold in (0, 1))
    start = datetime(1970, 1, 1, tzinfo=timezone.utc)
    return min((r.astimezone(timezone.utc) - start) // timedelta(milliseconds=1) for r in readings)
