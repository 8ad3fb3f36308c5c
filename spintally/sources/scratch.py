"""Tables that a job needs for a while, in the shared folder that the cluster names.

:func:`kept` writes one for the rest of the session, or of the innermost :func:`scratch` block, whose
tables are deleted when it ends; what :func:`handed_on` writes goes with the block around it. Tables
that outlive every block are deleted when the session's JVM ends.
"""

from __future__ import annotations

import gc
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

_own_folders: dict[str, str] = {}
# Local folders by application, which its executors share.
_tried: set[tuple[str, str]] = set()
# Paths of each block that is open, the innermost last.
_blocks: ContextVar[tuple[list[str], ...]] = ContextVar("scratch blocks", default=())


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; in local mode without one, a folder of our own.

    Elsewhere a folder has to be named that the driver and all executors share, which may be
    one that is mounted on each machine and so looks like a local one. A folder that looks local is
    tried once: were it on a machine's own disk, each executor would write to its own
    and read what happens to be there. ``local-cluster`` runs all its executors on
    one machine, so a local folder is shared there.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_SETTING, None) or context.getCheckpointDir()
    one_machine = context.master.startswith("local")
    if named is None:
        if not one_machine:
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder that every executor can reach")
        app = context.applicationId
        if app not in _own_folders:
            _own_folders[app] = tempfile.mkdtemp(prefix="run-")
            _delete_at_exit(spark, _own_folders[app])
        return _own_folders[app]
    named = named.rstrip("/")
    tried = (context.applicationId, named)
    if not one_machine and tried not in _tried and _file_system(spark, named).getScheme() == "file":
        if not _is_shared(spark, named):
            raise RuntimeError(f"{CHECKPOINT_SETTING} is {named}, which each executor has for itself")
        _tried.add(tried)
    return named


def _is_shared(spark: SparkSession, folder: str) -> bool:
    """Whether the driver finds what every task writes there."""
    path = f"{folder}/tried-{uuid4().hex}"
    tasks = 2 * spark.sparkContext.defaultParallelism
    try:
        rows = spark.range(0, tasks, 1, tasks)
        rows.write.parquet(path)
        return spark.read.schema(rows.schema).parquet(path).count() == tasks
    finally:
        discard(spark, [path])


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration())


def _delete_at_exit(spark: SparkSession, path: str) -> None:
    _file_system(spark, path).deleteOnExit(spark._jvm.org.apache.hadoop.fs.Path(path))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the session's JVM ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid4().hex}"
    _delete_at_exit(spark, path)
    return path


@contextmanager
def noted(paths: list[str]) -> Iterator[None]:
    """Adds the paths of tables that are written inside to ``paths``."""
    token = _blocks.set((*_blocks.get(), paths))
    try:
        yield
    finally:
        _blocks.reset(token)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that :func:`kept` writes inside are deleted at the end."""
    paths: list[str] = []
    try:
        with noted(paths):
            yield
    finally:
        discard(spark, paths)
        drop_ended_shuffles(spark)


def drop_ended_shuffles(spark: SparkSession) -> None:
    """Has Spark delete the shuffle files of queries that have ended.

    It does so once the driver has collected the plans they belong to, which by itself may be long after.
    The plan of the last query is held until another one has run, so a small one does.
    """
    spark.range(1).collect()
    gc.collect()
    spark._jvm.System.gc()


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Deletes these tables."""
    while paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(paths.pop())
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    This cuts the lineage: a lost executor costs a re-read, not a new run of the
    plan. Spark knows the table's true size, so it broadcasts it only where it is
    small enough.
    """
    return _written(df, name, _blocks.get())


def handed_on(df: DataFrame, name: str) -> DataFrame:
    """As :func:`kept`, for the block around the innermost one."""
    return _written(df, name, _blocks.get()[:-1])


def _written(df: DataFrame, name: str, blocks: tuple[list[str], ...]) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    if blocks:
        blocks[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def written_once(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` written to the shared folder and read back, deleted at the end.

    Readers get a columnar table they can prune and filter, and a lost executor
    costs them a re-read instead of a new pass over the raw events.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid4().hex}"
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        discard(spark, [path])
