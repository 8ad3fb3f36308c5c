"""Reading raw session events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spintally.schema import MONEY_COLUMNS, SESSION_SCHEMA, SESSION_TABLE


def is_path(location: str) -> bool:
    """Locations with a slash are folders; anything else is a catalog table."""
    return "/" in location


def session_table(database: str, table: str = SESSION_TABLE) -> str:
    """Qualified name of the raw table in one database, or one catalog and database."""
    return f"{database}.{table}"


def read_sessions(
    spark: SparkSession, location: str, schema: T.StructType | None = None
) -> DataFrame:
    """Raw events from a Parquet folder or a catalog table, checked by :func:`conform`.

    The files' own types count. A ``schema`` is a promise about them, and files
    that break it are refused. Every rollup also takes any other DataFrame of
    these columns, so a source in another format needs only its own reader.
    """
    found = spark.read.parquet(location) if is_path(location) else spark.read.table(location)
    if schema is not None:
        types = {field.name: field.dataType for field in found.schema}
        differ = [f.name for f in schema if f.name in types and types[f.name] != f.dataType]
        if differ:
            raise TypeError(f"{location} has other types than promised: {', '.join(differ)}")
    return conform(found)


def conform(events: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """The contract's columns in order and type, plus any ``extra`` ones.

    Whole-number money widens to bigint and decimal money stays as it is.
    Floating-point money is refused: its sums would depend on row order.
    """
    found = {field.name: field.dataType for field in events.schema}
    missing = [name for name in (*SESSION_SCHEMA.names, *extra) if name not in found]
    if missing:
        raise ValueError(f"session events lack the columns {', '.join(missing)}")
    columns = []
    for field in SESSION_SCHEMA:
        wanted = field.dataType
        if field.name in MONEY_COLUMNS:
            if isinstance(found[field.name], T.FractionalType) and not isinstance(
                found[field.name], T.DecimalType
            ):
                raise TypeError(f"{field.name} is floating point; use bigint or decimal")
            if isinstance(found[field.name], T.DecimalType):
                wanted = found[field.name]
        columns.append(F.col(field.name).cast(wanted).alias(field.name))
    return events.select(*columns, *extra)
