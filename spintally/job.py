"""One run of the rollups over one database or many, for ``spark-submit``.

    spark-submit run_rollups.py --target lake.rollups site_a=lake.site_a site_b=lake.site_b

A source is a database, or a folder, that holds the two raw tables. Several
named sources share one set of target tables keyed by tenant; a single source
without a name gets targets without that key. Sources fail apart: one that cannot
be read, or whose money has another type than the stored rows, is left out, and if
the joint job fails, halves of the sources are refreshed until the failing ones are found. The others are up
to date when the run ends with an error that names the failed ones, and ``--only`` runs these
again. An error of the targets, which no source caused, ends the run at once.
"""

from __future__ import annotations

import argparse
from collections import Counter
from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from spintally.functions.buckets import UTC
from spintally.plans.refresh import Events, Starts, default_targets, refresh_all
from spintally.plans.targets import Target, TargetError
from spintally.schema import BUDGET_COLUMN, FLOOR_TABLE, MONEY_COLUMNS, SESSION_TABLE
from spintally.sources.sessions import is_path, read_sessions, session_table
from spintally.sources.tenants import TENANT, matching, read_tenants

RAW_TABLES = (SESSION_TABLE, FLOOR_TABLE)


def raw_table(source: str, name: str) -> str:
    """Location of a raw table in a database or folder."""
    return f"{source.rstrip('/')}/{name}" if is_path(source) else session_table(source, name)


def run(
    spark: SparkSession,
    sources: str | Mapping[str, str],
    target: str,
    *,
    pattern: str = "%",
    only: Collection[str] | None = None,
    models: Collection[str] | None = None,
    rebuilt: Collection[str] = ("game_by_day",),
    lookback: int = 0,
    tz: str = UTC,
    null_safe_totals: bool = True,
    places: Mapping[str, str] | None = None,
) -> dict[str, Starts]:
    """Refresh the rollups named in ``models``, or all six; returns where each started.

    ``places`` gives single rollups another folder or database than ``target``.
    """
    single = isinstance(sources, str)
    by = () if single else (TENANT,)
    targets = default_targets(target, by=by)
    unknown = (set(models or ()) | set(places or ())) - set(targets)
    if unknown:
        raise ValueError(f"no rollup named {', '.join(sorted(unknown))}")
    for name, place in (places or {}).items():
        targets[name] = default_targets(place, by=by)[name]
    chosen = {name: t for name, t in targets.items() if models is None or name in models}

    def refreshed(session_events: Events, floor_events: Events) -> dict[str, Starts]:
        return refresh_all(
            session_events,
            chosen,
            floor_events,
            rebuilt=rebuilt,
            lookback=lookback,
            tz=tz,
            null_safe_totals=null_safe_totals,
        )

    if single:
        return refreshed(*(read_sessions(spark, raw_table(sources, t)) for t in RAW_TABLES))
    wanted = [n for n in matching(sources, pattern) if only is None or n in only]
    failed: dict[str, Exception] = {}
    frames: dict[str, list[DataFrame]] = {}
    for name in wanted:
        try:
            located = [raw_table(sources[name], table) for table in RAW_TABLES]
            frames[name] = [read_tenants(spark, {name: place})[name] for place in located]
        except Exception as error:  # noqa: BLE001 - any failure of one source is its own
            failed[name] = error

    def together(names: Collection[str]) -> dict[str, Starts]:
        return refreshed(*({n: frames[n][i] for n in names} for i in range(len(RAW_TABLES))))

    if frames:
        failed |= (refused := other_money(spark, chosen, frames))
        frames = {name: own for name, own in frames.items() if name not in refused}
    plans: dict[str, Starts] = {}
    groups = [list(frames)] if frames else []
    while groups:
        names = groups.pop()
        try:
            done = together(names)
        except TargetError:
            raise
        except Exception as error:  # noqa: BLE001
            if len(names) == 1:
                failed[names[0]] = error
            else:
                groups += [names[len(names) // 2 :], names[: len(names) // 2]]
            continue
        for rollup, starts in done.items():
            plans.setdefault(rollup, {}).update(starts)
    if failed:
        raise ExceptionGroup(f"sources failed: {', '.join(failed)}", list(failed.values()))
    if not frames:
        raise ValueError("no tenant matched")
    return plans


def other_money(
    spark: SparkSession, targets: Mapping[str, Target], frames: Mapping[str, list[DataFrame]]
) -> dict[str, Exception]:
    """Sources whose money has another type than the stored rows, or than most sources; schemas alone tell."""
    held = {target.look(spark).money for target in targets.values()} - {None}
    if len(held) > 1:
        raise TargetError(f"the rollups hold money of several types: {', '.join(sorted(held))}")
    own = {name: {tuple(frame.select(*MONEY_COLUMNS).dtypes) for frame in pair} for name, pair in frames.items()}
    kinds = Counter(kind for some in own.values() for kind in some)
    fitting = [kind for kind, _ in kinds.most_common() if not held or dict(kind)[BUDGET_COLUMN] in held]
    if not fitting:
        raise TargetError(f"the rollups hold money as {', '.join(held)}, and every source has another type")
    return {
        name: TypeError(f"{name} has money of other types than {dict(fitting[0])}")
        for name, some in own.items()
        if some != {fitting[0]}
    }


def parse(arguments: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Refresh the session rollups.")
    parser.add_argument("sources", nargs="+", help="database or folder, or name=database for each tenant")
    parser.add_argument("--target", required=True, help="database or folder of the rollup tables")
    parser.add_argument("--pattern", default="%", help="ILIKE pattern that tenant names must match")
    parser.add_argument("--only", nargs="*", help="tenants to run, instead of all")
    parser.add_argument("--models", nargs="*", help="rollups to run, instead of all")
    parser.add_argument("--rebuilt", nargs="*", default=["game_by_day"], help="rollups to replace in full")
    parser.add_argument("--lookback", type=int, default=0, help="buckets to go back for late events")
    parser.add_argument("--place", nargs="*", default=[], help="rollup=folder or database, apart from --target")
    parser.add_argument("--tz", default=UTC, help="time zone of the buckets")
    options = parser.parse_args(arguments)
    options.places = dict(place.split("=", 1) for place in vars(options).pop("place"))
    named = [source.partition("=") for source in options.sources]
    if all(equals for _, equals, _ in named):
        options.sources = {name: location for name, _, location in named}
    elif len(named) == 1:
        options.sources = named[0][0]
    else:
        parser.error("several sources need a name each, as in name=database")
    return options


def main() -> None:
    options = vars(parse())
    spark = SparkSession.builder.appName("session-rollups").getOrCreate()
    sources, target = options.pop("sources"), options.pop("target")
    for name, starts in run(spark, sources, target, **options).items():
        for tenant, start in starts.items():
            print(name, tenant or "", "from", start or "the beginning")
