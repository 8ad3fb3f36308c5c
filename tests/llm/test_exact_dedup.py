"""Exact dedup against the plain way."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from spintally.llm import exact_dedup
from tests.llm import plain

SPACES = dict.fromkeys(map(ord, " \t\n\x0b\x0c\r"))


def plain_groups(docs):
    """Per row of (id, text): id, the id that stays, the group's size, whether it stays, the digest."""
    groups = defaultdict(list)
    for doc_id, text in docs:
        text = text or ""
        groups[text.translate(SPACES)].append((-len(text), doc_id is None, doc_id or 0, doc_id))
    found = []
    for body, rows in groups.items():
        best = min(rows)
        found += [(row[3], best[3], len(rows), row == best, plain.sha(body)) for row in rows]
    return found


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def same(found, wanted):
    assert Counter(map(tuple, found)) == Counter(wanted)


@pytest.fixture(params=["small", "odd", "none"])
def docs(request, small, odd_docs, no_docs):
    return {"small": lambda: small("documents"), "odd": lambda: odd_docs, "none": lambda: no_docs}[request.param]()


def test_groups(docs):
    same(exact_dedup.judge(docs).collect(), plain_groups(rows_of(docs)))


@pytest.fixture(scope="module")
def copies(spark):
    """Spaces of every kind, characters that only look like spaces, a third of all rows equal, ties."""
    texts = ["a b", "ab", "a\tb\n", " a b ", "a b", "a b", "A b", "", " ", None, "\x0b\x0c", "a\x85b", "a\x00b", "é é", "éé"]
    rows = [(i % 40, text) for i, text in enumerate(texts * 4)]
    rows += [(1000 + i, "the same long text " * 50 + " " * (i % 3)) for i in range(60)]
    rows += [(None, "a b"), (None, "alone"), (2**63 - 1, "ab"), (-(2**63), "a b "), (-5, "a b ")]
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)


def test_copies(copies):
    same(exact_dedup.judge(copies).collect(), plain_groups(rows_of(copies)))


@pytest.mark.parametrize("chars", [1, 0])
def test_equal_digests_of_different_texts(copies, chars):
    """A digest of one or no character makes different contents meet at every step."""
    same(exact_dedup.judge(copies, digest_chars=chars).collect(), plain_groups(rows_of(copies)))


def test_one_of_each_keeps_whole_rows(odd_docs, copies):
    for docs in (odd_docs, copies):
        found = exact_dedup.one_of_each(docs)
        assert found.columns == docs.columns
        wanted = {(row[0], row[4]) for row in plain_groups(rows_of(docs)) if row[3]}
        body = exact_dedup.normalised(F.col("text"))
        got = [tuple(r) for r in found.select("doc_id", F.sha2(body, 256)).collect()]
        assert len(got) == len(set(got)) and set(got) == wanted


def test_rows_are_combined_before_each_of_two_shuffles(copies):
    plan = exact_dedup.winners(copies)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_min") == 2
    assert "Python" not in plan and "Join" not in plan


def test_only_large_groups_are_broadcast(spark):
    """Of 3000 rows, one content has a third; all others are joined by shuffle."""
    rows = [(i, f"text {i}" if i % 3 else "hot") for i in range(3000)]
    found = exact_dedup.winners(spark.createDataFrame(rows, "doc_id bigint, text string"))
    total = found.agg(F.sum("group_size")).first()[0]
    hot = found.filter(F.col("group_size") * exact_dedup.HOT_SHARE > total).collect()
    assert total == 3000 and [r.group_size for r in hot] == [1000]
