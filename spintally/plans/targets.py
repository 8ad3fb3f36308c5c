"""Stored rollups: Parquet folders or catalog tables, partitioned by bucket."""

from __future__ import annotations

import json
from collections.abc import Collection, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass
from functools import cached_property
from urllib.parse import unquote
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spintally.operators.rows import PLAYER_TYPE
from spintally.operators.slices import high_watermark, tenant_watermarks
from spintally.plans.rollups import Model
from spintally.schema import bucket_column
from spintally.sources.scratch import written_once
from spintally.sources.sessions import is_path
from spintally.sources.tenants import TENANT

DAY_FOLDER = "bucket_day"
# Readers pass over names that start with an underscore.
NOTES = "_unfinished_commits"
STAGED = "_staged"
DROPPED_AT_ONCE = 500
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


Partition = dict[str, str | None]
# First bucket of a commit, by tenant; None is all of history.
Starts = Mapping[str | None, str | None]


class TargetError(TypeError):
    """Rows that a target cannot hold, whatever source they come from."""


def _path(spark: SparkSession, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(name)


def _files(spark: SparkSession, location: str):
    return _path(spark, location).getFileSystem(spark._jsc.hadoopConfiguration())


def _partition(name: str) -> Partition:
    """Values by column, from a name such as ``tenant=a/day_bucket=2024-01-31``."""
    pairs = (part.partition("=") for part in name.split("/"))
    return {key: None if value == NULL_PARTITION else unquote(value) for key, _, value in pairs}


def _escaped(value: str | None) -> str:
    """A value as Spark writes it into a folder's name."""
    if value is None:
        return NULL_PARTITION
    special = set('"#%\'*/:=?\\{[]^\x7f') | {chr(code) for code in range(1, 32)}
    return "".join(f"%{ord(c):02X}" if c in special else c for c in value)


def _quoted(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Target:
    """Where one rollup is kept, and how its rows are laid out.

    ``by`` holds leading key columns such as the tenant. Hourly rollups are kept
    in one partition per day, since a folder per hour makes thousands of small
    files that every read has to list; ``day_folders=False`` gives hours their own.
    Money has the type of the events, which later events have to share; ``money``
    names it beforehand.
    """

    location: str
    model: Model
    grain: str
    by: tuple[str, ...] = ()
    day_folders: bool = True
    money: T.DataType | None = None

    @property
    def bucket(self) -> str:
        return bucket_column(self.grain)

    @property
    def columns(self) -> tuple[str, ...]:
        return self.model.columns(self.grain, self.by)

    @property
    def hours_share_folders(self) -> bool:
        return self.day_folders and self.grain == "hour"

    @property
    def partitions(self) -> tuple[str, ...]:
        return (*self.by, DAY_FOLDER if self.hours_share_folders else self.bucket)

    def look(self, spark: SparkSession) -> Snapshot:
        """What the target holds now, listed once."""
        return Snapshot(self, spark)

    def read(self, spark: SparkSession) -> DataFrame | None:
        """The stored rows in contract order, None if nothing was ever stored."""
        stored = self.stored(spark)
        return None if stored is None else stored.select(*self.columns)

    def stored(self, spark: SparkSession) -> DataFrame | None:
        """The stored rows with their partition columns."""
        return self.look(spark).rows()

    def partition_names(self, spark: SparkSession) -> list[Partition]:
        """Every stored partition, from the names of folders or the catalog; opens no file."""
        if is_path(self.location):
            names = self._folders(spark, self.location)
        elif spark.catalog.tableExists(self.location):
            names = [row[0] for row in spark.sql(f"SHOW PARTITIONS {self.location}").collect()]
        else:
            names = []
        return [_partition(name) for name in names]

    def _folders(self, spark: SparkSession, place: str) -> list[str]:
        depth = "/".join(["*=*"] * len(self.partitions))
        found = _files(spark, place).globStatus(_path(spark, f"{place}/{depth}"))
        names = [str(status.getPath()) for status in found or ()]
        return ["/".join(name.split("/")[-len(self.partitions) :]) for name in names]

    def folder(self, partition: Partition) -> str:
        """A partition's folder as Spark names it."""
        return "/".join(f"{c}={_escaped(partition[c])}" for c in self.partitions)

    def newest(self, spark: SparkSession) -> dict[str | None, str]:
        """Newest stored bucket of each tenant; under None for a target without tenants."""
        return self.look(spark).newest()

    @property
    def keyed_by_tenant(self) -> bool:
        return TENANT in self.by

    def replace(self, rows: DataFrame, tenants: Collection[str] | None = None) -> None:
        """Store these rows and nothing else; of ``tenants`` alone where they are given.

        The rows are worked out first, then swapped in by partition, and partitions
        without new rows are dropped last: if a step fails, what it would have
        replaced is still there.
        """
        spark = rows.sparkSession
        seen = self.look(spark)
        if tenants is not None:
            seen.check(rows)
        starts = dict.fromkeys([None] if tenants is None else tenants)
        mine = [one for one in seen.partitions if tenants is None or one.get(TENANT) in tenants]
        if is_path(self.location):
            staged = f"{self.location}/{STAGED}-{uuid4().hex}"
            self._writer(rows).save(staged)
            new = self._folders(spark, staged)
            with self.committing(spark, starts):
                self._move(spark, staged, new)
                self._drop(spark, [one for one in mine if self.folder(one) not in new])
            _files(spark, staged).delete(_path(spark, staged), True)
            return
        with written_once(self._arranged(rows), "replacement") as ready:
            kept = {tuple(row) for row in ready.select(*self.partitions).distinct().collect()}
            self._create(ready)
            with self.committing(spark, starts):
                if kept:
                    self.upsert(ready)
                self._drop(spark, [one for one in mine if tuple(one[c] for c in self.partitions) not in kept])

    def _move(self, spark: SparkSession, staged: str, folders: list[str]) -> None:
        """Puts staged folders in the place of the target's own."""
        files = _files(spark, self.location)
        for name in folders:
            place = _path(spark, f"{self.location}/{name}")
            files.delete(place, True)
            files.mkdirs(place.getParent())
            if not files.rename(_path(spark, f"{staged}/{name}"), place):
                raise OSError(f"could not move {name} into {self.location}")

    def _drop(self, spark: SparkSession, partitions: list[Partition]) -> None:
        if is_path(self.location):
            files = _files(spark, self.location)
            for one in partitions:
                files.delete(_path(spark, f"{self.location}/{self.folder(one)}"), True)
            return
        for start in range(0, len(partitions), DROPPED_AT_ONCE):
            some = partitions[start : start + DROPPED_AT_ONCE]
            named = ", ".join(
                "PARTITION (" + ", ".join(f"{c} = {_quoted(one[c])}" for c in self.partitions) + ")"
                for one in some
            )
            spark.sql(f"ALTER TABLE {self.location} DROP IF EXISTS {named}")

    # --- A commit that was cut off ------------------------------------------------

    @contextmanager
    def committing(self, spark: SparkSession, starts: Starts) -> Iterator[None]:
        """Notes where a commit starts before anything is swapped, until it has ended.

        Partitions are deleted before new ones take their place, so a commit that is
        cut off can lose any of them, and in its first run it leaves newer ones without
        the older. A run that finds the note starts there again. Every commit has a note of
        its own, so that runs of other tenants neither lose nor shorten it.
        """
        self.mark(spark, starts)
        yield
        self.unmark(spark, starts)

    def mark(self, spark: SparkSession, starts: Starts) -> None:
        """Notes where a commit starts; hours that share a folder may all be lost, so theirs is midnight."""
        if self.hours_share_folders:
            starts = {name: label and f"{label[:10]} 00:00:00" for name, label in starts.items()}
        self._put_note(spark, starts)

    def unmark(self, spark: SparkSession, names: Collection[str | None] | None = None) -> None:
        """Takes these tenants out of all notes, or removes all notes."""
        for key, starts in self._notes(spark).items():
            left = {} if names is None else {n: at for n, at in starts.items() if n not in names}
            if left == starts:
                continue
            if left:
                self._put_note(spark, left)
            if is_path(self.location):
                _files(spark, key).delete(_path(spark, key), False)
            else:
                spark.sql(f"ALTER TABLE {self.location} UNSET TBLPROPERTIES IF EXISTS ('{key}')")

    def cut_off(self, spark: SparkSession) -> dict[str | None, str | None]:
        """The earliest start of the commits that did not end, by tenant."""
        found: dict[str | None, str | None] = {}
        for starts in self._notes(spark).values():
            for name, label in starts.items():
                known = found.get(name, label)
                found[name] = None if None in (label, known) else min(label, known)
        return found

    def _put_note(self, spark: SparkSession, starts: Starts) -> None:
        note = json.dumps([[name, label] for name, label in starts.items()])
        if not is_path(self.location):
            key = f"{NOTES}.{uuid4().hex}"
            spark.sql(f"ALTER TABLE {self.location} SET TBLPROPERTIES ('{key}' = {_quoted(note)})")
            return
        place = f"{self.location}/{NOTES}/{uuid4().hex}"
        files = _files(spark, place)
        out = files.create(_path(spark, place), True)
        out.write(bytearray(note.encode()))
        out.close()
        # Only a whole note has its name.
        files.rename(_path(spark, place), _path(spark, f"{place}.json"))

    def _notes(self, spark: SparkSession) -> dict[str, Starts]:
        """Notes by file name or table property."""
        texts = {}
        if is_path(self.location):
            files = _files(spark, self.location)
            for status in files.globStatus(_path(spark, f"{self.location}/{NOTES}/*.json")) or ():
                source = files.open(status.getPath())
                texts[str(status.getPath())] = spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
                source.close()
        elif spark.catalog.tableExists(self.location):
            found = spark.sql(f"SHOW TBLPROPERTIES {self.location}")
            texts = dict(found.filter(F.col("key").startswith(f"{NOTES}.")).collect())
        return {key: dict(map(tuple, json.loads(text))) for key, text in texts.items()}

    # --- Writing --------------------------------------------------------------------

    def upsert(self, rows: DataFrame) -> None:
        """Replace every partition that has rows here, and leave the others alone.

        A refresh works its buckets out whole, so swapping whole partitions gives
        the same table as replacing rows by key, also where a key is NULL. Files
        are staged and moved in at the end, so the rows may come from this target.
        """
        if is_path(self.location):
            writer = self._writer(rows)
            writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").save(self.location)
            return
        self._create(rows)
        stored_order = rows.sparkSession.read.table(self.location).columns
        writer = self._arranged(rows).select(*stored_order).write
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(self.location)

    def _create(self, rows: DataFrame) -> None:
        """An empty table for the first rows, so that their commit can be noted in it."""
        if not is_path(self.location) and not rows.sparkSession.catalog.tableExists(self.location):
            # Inserts take the mode from the table's own options.
            self._writer(rows.limit(0)).option("partitionOverwriteMode", "dynamic").saveAsTable(self.location)

    def _arranged(self, rows: DataFrame) -> DataFrame:
        """Rows gathered by partition for large files; an oversized partition is split."""
        if self.hours_share_folders and DAY_FOLDER not in rows.columns:
            rows = rows.withColumn(DAY_FOLDER, F.substring(self.bucket, 1, 10))
        inner = (c for c in (self.bucket, *self.model.keys, PLAYER_TYPE) if c in self.columns)
        order = dict.fromkeys((*self.partitions, *inner))
        return rows.hint("rebalance", *self.partitions).sortWithinPartitions(*order)

    def _writer(self, rows: DataFrame) -> DataFrameWriter:
        return self._arranged(rows).write.format("parquet").partitionBy(*self.partitions)


class Snapshot:
    """What a target held when it was looked at: its partitions, and commits that were cut off.

    The target's folders are listed once; only those that are read are listed again.
    """

    def __init__(self, target: Target, spark: SparkSession):
        self.target = target
        self.spark = spark
        self.partitions = target.partition_names(spark)
        self.notes = target.cut_off(spark)

    @cached_property
    def schema(self) -> T.StructType:
        """Of folders, the newest one's files tell the types, and partition columns are text."""
        target = self.target
        if not is_path(target.location):
            return self.spark.read.table(target.location).schema
        newest = max(self.partitions, key=lambda one: one[target.partitions[-1]] or "")
        try:
            found = self.spark.read.parquet(f"{target.location}/{target.folder(newest)}").schema
        except AnalysisException:  # a folder that a commit left empty
            found = self.spark.read.parquet(target.location).schema
        fields = [field for field in found if field.name not in target.partitions]
        # Bucket folders would be read as timestamps.
        return T.StructType([*fields, *(T.StructField(c, T.StringType()) for c in target.partitions)])

    @property
    def money(self) -> str | None:
        """The type of the stored money, which is the events' own; None if nothing is stored."""
        if self.target.money is not None:
            return self.target.money.simpleString()
        return self.schema["max_player_budget"].dataType.simpleString() if self.partitions else None

    def rows(self, chosen: list[Partition] | None = None) -> DataFrame | None:
        """The stored rows, or those of the chosen partitions; None if nothing is stored."""
        target, spark = self.target, self.spark
        if not is_path(target.location):
            if not spark.catalog.tableExists(target.location):
                return None
            stored = spark.read.table(target.location)
            if chosen is None:
                return stored
            named = F.concat_ws("/", *(F.coalesce(c, F.lit(NULL_PARTITION)) for c in target.partitions))
            values = ["/".join(one[c] or NULL_PARTITION for c in target.partitions) for one in chosen]
            last = target.partitions[-1]
            least = min((one[last] or "" for one in chosen), default="")
            # The first comparison is the one the reader can use to skip partitions.
            return stored.filter((F.col(last) >= least) & named.isin(values))
        if not self.partitions:
            return None
        if chosen is not None and not chosen:
            return spark.createDataFrame([], self.schema)
        places = [target.location] if chosen is None else [f"{target.location}/{target.folder(one)}" for one in chosen]
        return spark.read.schema(self.schema).option("basePath", target.location).parquet(*places)

    def newest(self) -> dict[str | None, str]:
        """Newest stored bucket of each tenant; under None for a target without tenants.

        Partition names tell it, and for hours in day folders they tell the day:
        of each tenant's newest day alone the files are read.
        """
        target = self.target
        key = target.partitions[-1]
        days: dict[str | None, str] = {}
        for one in self.partitions:
            tenant = one.get(TENANT)
            if one[key] is not None:
                days[tenant] = max(days.get(tenant, ""), one[key])
        if not target.hours_share_folders or not days:
            return days
        stored = self.rows([one for one in self.partitions if one[key] == days.get(one.get(TENANT))])
        if target.keyed_by_tenant:
            return tenant_watermarks(stored, target.bucket, TENANT)
        label = high_watermark(stored, target.bucket)
        return {} if label is None else {None: label}

    def check(self, rows: DataFrame) -> None:
        """Refuses rows of other types than the stored ones, before anything is written."""
        target = self.target
        have = dict(rows.dtypes)
        if target.money is not None and have["max_player_budget"] != target.money.simpleString():
            raise TargetError(f"{target.location} is to hold money as {target.money.simpleString()}")
        held = {field.name: field.dataType.simpleString() for field in self.schema} if self.partitions else {}
        differ = [c for c, kind in held.items() if have.get(c, kind) != kind]
        if differ:
            raise TargetError(f"{target.location} holds other types of {', '.join(differ)}")
