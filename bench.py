"""Times the six rollups, and refreshes of stored ones, and prints one JSON line.

Reads ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``. Every query runs once to warm
up and then ``$BENCH_RUNS`` times; the median counts. Two more inputs are made from
the same events: ``$BENCH_COPIES`` copies of them, moved apart in time, and the
same with a third of all rows in one floor location and machine.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from spintally.checks.fixture import session_events  # noqa: E402
from spintally.plans import rollups  # noqa: E402
from spintally.plans.refresh import default_targets, refresh, refresh_all  # noqa: E402

DATA = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
COPIES = int(os.environ.get("BENCH_COPIES", "5"))
ROLLUPS = (
    "player_by_hour",
    "player_by_day",
    "floor_by_hour",
    "floor_by_day",
    "game_by_hour",
    "game_by_day",
)


def session(work: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("spintally-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{work}/shared")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def enlarged(events: DataFrame, copies: int, hot: bool) -> DataFrame:
    """Copies of the events a month apart each; ``hot`` puts a third of them in one place."""
    month = 31 * 24 * 3_600_000
    many = events.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    moved = many.withColumn("eventTime", F.col("eventTime") + F.col("copy") * month).drop("copy")
    if not hot:
        return moved
    third = F.pmod(F.xxhash64("eventTime", "sessionUuid"), F.lit(3)) == 0
    return moved.withColumns(
        {c: F.when(third, "hot").otherwise(F.col(c)) for c in ("floorLocation", "assetNumber")}
    )


def drain(df: DataFrame) -> None:
    """Work out every row and column, and keep nothing."""
    df.write.format("noop").mode("overwrite").save()


def timed(run) -> float:
    run()
    seconds = []
    for _ in range(RUNS):
        start = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 3)


def main() -> None:
    work = tempfile.mkdtemp(prefix="run-bench-")
    spark = session(work)
    # Session events as a stored table of one file per core, so that times are of
    # rollups alone.
    raw = f"{work}/session_data"
    session_events(spark, DATA).repartition(int(CPUS)).write.parquet(raw)
    events = spark.read.parquet(raw)

    took = {}
    for name in ROLLUPS:
        took[name] = timed(lambda: drain(getattr(rollups, name)(events)))

    targets = default_targets(f"{work}/stored")
    daily = {name: target for name, target in targets.items() if name.endswith("_by_day")}
    refresh_all(events, targets)
    took["refresh_newest_hour"] = timed(lambda: refresh(events, targets["floor_by_hour"]))
    took["refresh_newest_day"] = timed(lambda: refresh(events, targets["floor_by_day"]))
    took["refresh_all_newest"] = timed(lambda: refresh_all(events, targets, rebuilt=()))
    took["rebuild_daily_together"] = timed(lambda: refresh_all(events, daily, rebuilt=daily))

    total = round(sum(took.values()), 3)
    took["refresh_all_default"] = timed(lambda: refresh_all(events, targets))
    for kind, hot in (("larger", False), ("skewed", True)):
        place = f"{work}/{kind}"
        enlarged(events, COPIES, hot).repartition(int(CPUS)).write.parquet(place)
        for name in ("floor_by_hour", "game_by_day"):
            grown = spark.read.parquet(place)
            took[f"{name}_{kind}"] = timed(lambda: drain(getattr(rollups, name)(grown)))

    print(
        json.dumps(
            {
                "metric": "total time of six full rollups and four refreshes",
                "value": total,
                "unit": "sec",
                "queries": took,
                "sf": Path(DATA).name.removeprefix("sf"),
                "rows": events.count(),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
