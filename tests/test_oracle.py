"""Every registered query against its SQL twin, over whole tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from spintally.checks import oracle, queries

DATA = "/root/testdata/sf0.01"
QUERIES, ORACLES = queries.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for file in Path(DATA).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _sorted(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


_TYPES = {"BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean"}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, db, name):
    found = QUERIES[name](spark, DATA)
    wanted = db.execute(ORACLES[name])
    names = [c[0] for c in wanted.description]
    types = {c[0]: _TYPES[str(c[1])] for c in wanted.description}
    assert types == dict(found.dtypes)
    left = _sorted([tuple(r) for r in found.collect()], found.columns)
    right = _sorted(wanted.fetchall(), names)
    assert left, "an empty result checks nothing"
    assert len(left) == len(right)
    assert [pair for pair in zip(left, right) if pair[0] != pair[1]] == []
