"""Bucket numbers, labels and slice bounds, also across clock changes."""

from __future__ import annotations

from datetime import datetime, timezone
from zoneinfo import ZoneInfo

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spintally.functions.buckets import (
    bucket_label,
    bucket_number,
    day_of_hour,
    earliest_event_time,
    format_label,
    parse_label,
)
from spintally.operators.slices import since_slice
from spintally.plans import rollups as R
from tests.events import HOUR, event, table

NEW_YORK = "America/New_York"
CLOCKS_BACK = 1_730_613_600_000  # 2024-11-03 06:00:00 UTC, 02:00 EDT becomes 01:00 EST


def wall(ms: int, tz: str) -> datetime:
    return datetime.fromtimestamp(ms // 1000, timezone.utc).astimezone(ZoneInfo(tz))


@pytest.mark.parametrize("tz", ["UTC", NEW_YORK, "Asia/Kathmandu", "Australia/Lord_Howe"])
@pytest.mark.parametrize("session_tz", ["UTC", "America/Los_Angeles"])
def test_labels_follow_the_wall_clock(spark, tz, session_tz):
    times = [CLOCKS_BACK + step * HOUR // 4 for step in range(-20, 20)]
    times += [1_712_000_000_000 + step * HOUR // 2 for step in range(-400, 400)]
    spark.conf.set("spark.sql.session.timeZone", session_tz)
    try:
        frame = spark.createDataFrame([(t,) for t in times], "t bigint")
        hour, day = (bucket_number(F.col("t"), g, tz) for g in ("hour", "day"))
        found = frame.select(
            "t", bucket_label(hour, "hour"), bucket_label(day, "day"), day_of_hour(hour) == day
        ).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    for t, hour_text, day_text, same_day in found:
        local = wall(t, tz)
        assert hour_text == local.strftime("%Y-%m-%d %H:00:00")
        assert day_text == local.strftime("%Y-%m-%d 00:00:00")
        assert same_day


def test_a_repeated_hour_is_one_bucket(spark):
    events = table(spark, [event(at=CLOCKS_BACK - HOUR), event(at=CLOCKS_BACK)])
    [found] = R.player_by_hour(events, tz=NEW_YORK).collect()
    assert (found.hour_bucket, found.total_spins) == ("2024-11-03 01:00:00", 2)
    assert found.total_session_counts == 1


@settings(max_examples=300, deadline=None)
@given(
    st.integers(min_value=0, max_value=4_000_000_000),
    st.sampled_from(["UTC", NEW_YORK, "Australia/Lord_Howe", "Pacific/Apia", "America/Havana"]),
    st.sampled_from(["hour", "day"]),
)
def test_bound_never_cuts_into_a_bucket(seconds, tz, grain):
    local = wall(seconds * 1000, tz)
    label = local.strftime("%Y-%m-%d %H:00:00" if grain == "hour" else "%Y-%m-%d 00:00:00")
    number = parse_label(label, grain)
    assert format_label(number, grain) == label
    assert earliest_event_time(number, grain, tz) <= seconds * 1000


@pytest.mark.parametrize("tz", ["UTC", NEW_YORK, "Australia/Lord_Howe"])
@pytest.mark.parametrize("grain", ["hour", "day"])
def test_slice_equals_comparing_labels(spark, tz, grain):
    times = [CLOCKS_BACK + step * HOUR // 4 for step in range(-150, 150)]
    events = table(spark, [event(at=t) for t in times])
    label = bucket_label(bucket_number(F.col("eventTime"), grain, tz), grain)
    labels = dict(events.select("eventTime", label).collect())
    for since in sorted(set(labels.values()))[::12]:
        found = since_slice(events, since, grain, tz).select("eventTime").collect()
        assert {r[0] for r in found} == {t for t, text in labels.items() if text >= since}


def test_lookback_moves_whole_buckets(spark):
    events = table(spark, [event(at=h * HOUR) for h in range(10)])
    assert since_slice(events, "1970-01-01 05:00:00", "hour").count() == 5
    assert since_slice(events, "1970-01-01 05:00:00", "hour", lookback=2).count() == 7
    assert since_slice(events, None, "hour").count() == 10


def test_unknown_grain_is_refused():
    with pytest.raises(ValueError, match="week"):
        R.FLOOR.columns("week")
