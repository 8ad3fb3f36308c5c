from __future__ import annotations

import random

import pytest

SMALL = "/root/testdata/sf0.001"
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, words string, counts string,"
    " _words string, hash string, size string, shard string, slot string, key string, n string, doc string"
)


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices("abcdeé", k=rng.randint(1, 6))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """NULLs in any column, empty and long texts, near copies, repeated rows and ids, other columns."""
    rng = random.Random(5)
    base = [words(rng, n) for n in (3, 8, 12, 40, 60, 200)]
    texts = [None, "", " \n\t ", *base, *base, base[3] + " extra", "Head " + base[4], base[5].upper()]
    texts += [words(rng, 30_000), "same line\nsame line\nsame line\n" * 8, "#$% " * 30, base[5] + " " + base[3]]
    rows = []
    for i, text in enumerate(texts):
        rows.append((i, text, [None, "en", "de"][i % 3], [None, "a", "b", "c"][i % 4], None))
    rows.append(rows[6])
    rows.append(rows[6])
    rows += [(None, base[4], None, None, 1), (None, None, None, None, None), (7, base[2] + " other", "en", "a", 2)]
    extra = tuple("x" for _ in range(10))
    return spark.createDataFrame([row + extra for row in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    return lambda name: spark.read.parquet(f"{SMALL}/{name}.parquet")
