"""The operators that SQL can express against their SQL twins, over whole tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from spintally.llm import oracle, queries

DATA = "/root/testdata/sf0.01"


def test_queries_are_registered():
    names = set(entry.queries())
    assert set(queries.queries()) | {"pipeline"} <= names
    assert {name.split("_")[0] for name in names} >= {f"op{n}" for n in range(1, 11)}


@pytest.mark.parametrize("name", oracle.oracle_sql())
def test_query_equals_oracle(spark, name):
    db = duckdb.connect()
    for file in Path(DATA).glob("*.parquet"):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    wanted = db.execute(oracle.oracle_sql()[name])
    names = [c[0] for c in wanted.description]
    found = queries.queries()[name](spark, DATA)
    assert sorted(names) == sorted(found.columns)
    left = sorted(map(tuple, found.select(*names).collect()), key=repr)
    right = sorted(wanted.fetchall(), key=repr)
    assert [pair for pair in zip(left, right) if pair[0] != pair[1]] == []
    assert len(left) == len(right) > 0
