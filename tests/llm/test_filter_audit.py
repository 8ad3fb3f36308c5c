"""The filter audit against counting documents order by order."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from itertools import permutations
from math import factorial

import pytest

from spintally.llm import filter_audit
from tests.llm import plain


def failures(docs):
    """Per row of (id, text, source) the filters that it fails."""
    first = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    found = []
    for doc_id, text, source in docs:
        text = text or ""
        words = plain.spaced(text)
        rules = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc_id is not None and first[text] < doc_id,
        }
        found.append((doc_id, source or "", {f for f, fails in rules.items() if fails}))
    return found


def plain_audit(docs, labels):
    good = {doc_id for doc_id, quality, _ in labels if quality == 1 and doc_id is not None}
    toxic = {doc_id for doc_id, _, is_toxic in labels if is_toxic == 1 and doc_id is not None}
    parts = defaultdict(list)
    for doc_id, part, failed in failures(docs):
        parts[part].append((doc_id, failed))
    found, removals = {}, Counter()
    for part, rows in parts.items():
        for order in map("".join, permutations("ABCDE")):
            left = rows
            for step, own in enumerate(order, 1):
                gone = [row for row in left if own in row[1]]
                left = [row for row in left if own not in row[1]]
                failing = sum(own in failed for _, failed in rows)
                alone = sum(failed == {own} for _, failed in rows)
                lost = [sum(row[0] in tagged for row in gone) for tagged in (good, toxic)]
                found[part, order, step] = (len(left), len(gone), failing - len(gone), alone, *lost)
                removals[part, own] += len(gone)
    return {(*key, *counts, removals[key[0], key[1][key[2] - 1]]) for key, counts in found.items()}


@pytest.fixture(params=["small", "odd", "none"])
def tables(request, spark, small, odd_docs, no_docs):
    schema = "doc_id bigint, quality int, toxic int, text string"
    odd = [(i % 30, i % 2, (i // 2) % 3 or None, "x") for i in range(45)] + [(None, 1, 1, None), (3, None, None, "y")]
    return {
        "small": lambda: (small("documents"), small("labels")),
        "odd": lambda: (odd_docs, spark.createDataFrame(odd, schema)),
        "none": lambda: (no_docs, spark.createDataFrame([], schema)),
    }[request.param]()


def test_every_order(tables):
    docs, labels = tables
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    tags = [(r.doc_id, r.quality, r.toxic) for r in labels.collect()]
    found = [tuple(r) for r in filter_audit.audit(docs, labels).collect()]
    assert len(found) == len(set(found))
    assert set(found) == plain_audit(rows, tags)


def test_texts_that_repeat(spark, small):
    """A third of all rows share a text; ids repeat, the smallest one too, and parts share texts."""
    rows = [(i, "hot", "a" if i % 2 else None) for i in range(40)] + [(0, "hot", "a"), (0, "hot", "b"), (None, "hot", "a")]
    rows += [(i % 7, "other", "b") for i in range(20)] + [(i, None if i % 2 else "", "c") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)
    found = {tuple(r) for r in filter_audit.audit(docs, small("labels")).collect()}
    tags = [(r.doc_id, r.quality, r.toxic) for r in small("labels").collect()]
    assert found == plain_audit(rows, tags)


@pytest.mark.parametrize("k", [1, 2, 5])
def test_path_counts(k):
    """Every edge has the orders that go through it, and every order takes k edges."""
    counts = filter_audit.path_counts(k)
    through = Counter()
    for order in permutations(range(k)):
        for at, one in enumerate(order):
            through[sum(1 << f for f in order[:at]), one] += 1
    assert counts == through
    assert sum(counts.values()) == k * factorial(k)


def test_shapley_sums_add_up(small):
    """Over all filters they give the removals of every order."""
    found = filter_audit.audit(small("documents"), small("labels")).filter("part = 'src0'").collect()
    sums = {r.filter_order[r.step - 1]: r.shapley for r in found}
    removed = sum(r.removed for r in found if r.filter_order == "ABCDE")
    assert sum(sums.values()) == factorial(5) * removed


def test_texts_stay_out_of_shuffles(small):
    sets = filter_audit.failed_sets(small("documents"), small("labels"), filter_audit.text_filters())
    plan = sets._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    assert not [line for line in plan.split("\n") if "Exchange" in line and "text" in line]
