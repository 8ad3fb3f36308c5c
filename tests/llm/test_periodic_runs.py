"""Periodic runs against a search of every period."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from spintally.llm import periodic_runs
from tests.llm import plain


def plain_runs(words):
    found, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            stretch = words[start : start + length]
            smaller = any(all(stretch[k] == stretch[k + r] for k in range(length - r)) for r in range(1, q))
            if length >= max(6, 4 * q) and not smaller:
                found.append((start, length, q))
    return sorted(found, key=lambda run: (run[0], run[2]))


def plain_report(doc_id, text):
    words = plain.spaced(text)
    if doc_id is not None and words:
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(words)
    dropped = {i for start, length, q in runs for i in range(start + q, start + length)}
    best = min(runs, key=lambda run: (-run[1], run[0], run[2]), default=None)
    shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    rest = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    return doc_id, len(runs), *shown, hashlib.sha256(lines.encode()).hexdigest(), plain.sha(rest)


periodic = st.lists(
    st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=7), st.integers(1, 8)), max_size=4
).map(lambda parts: [word for base, times in parts for word in base * times])


@settings(max_examples=300, deadline=None)
@given(st.one_of(periodic, st.lists(st.integers(0, 2), max_size=40)))
def test_runs(words):
    assert periodic_runs.runs_of(np.array(words, np.int64)) == plain_runs(words)


def test_runs_in_runs():
    inner = [0, 0, 0, 0, 0, 0, 1]
    words = inner * 4
    assert (0, 28, 7) in periodic_runs.runs_of(np.array(words))
    assert periodic_runs.runs_of(np.array(words)) == plain_runs(words)


def test_long_texts_take_little_more_than_linear_time():
    """One word, one long period, and two words at random, a hundred thousand words each."""
    n = 100_000
    assert periodic_runs.runs_of(np.zeros(n, np.int64)) == [(0, n, 1)]
    assert periodic_runs.runs_of(np.arange(n) % 997) == [(0, n, 997)]
    coins = np.random.default_rng(2).integers(0, 2, n)
    found = periodic_runs.runs_of(coins)
    ones = [run for run in plain_runs(coins[:2000].tolist()) if run[0] + run[1] < 1900]
    assert [run for run in found if run[0] + run[1] < 1900] == ones


def test_positions_stay_in_order():
    rng = np.random.default_rng(3)
    numbers = rng.permutation(5000).tolist()
    own = periodic_runs.Positions(numbers[0])
    for i, number in enumerate(numbers[1:], 1):
        earlier = numbers[:i] if i < 300 else None
        before, after = own.add(number)
        if earlier:
            assert before == max((x for x in earlier if x < number), default=None)
            assert after == min((x for x in earlier if x > number), default=None)
    assert list(own) == sorted(numbers)
    assert len(own.blocks) > 2


@pytest.fixture(params=["small", "odd", "none", "made"])
def docs(request, spark, small, odd_docs, no_docs):
    def made():
        texts = ["x " * 9, "a b c " * 5, "  " * 8, "a b a b a b a b c c c c c c", "one\ttwo\n" * 30]
        rows = [(i, texts[i % 5]) for i in range(200)] + [(None, texts[0]), (2**63 - 1, texts[1]), (-3, texts[2])]
        return spark.createDataFrame(rows, "doc_id bigint, text string")

    return {
        "small": lambda: small("documents"),
        "odd": lambda: odd_docs.filter("length(text) < 20000 or text is null"),
        "none": lambda: no_docs,
        "made": made,
    }[request.param]()


def test_report(docs):
    found = periodic_runs.report(docs)
    assert Counter(map(tuple, found.collect())) == Counter(plain_report(r.doc_id, r.text) for r in docs.collect())


def test_operator_gives_runs_and_text(spark):
    docs = spark.createDataFrame([(1, "go a b a b a b a b stop"), (2, None)], "doc_id bigint, text string")
    found = {r.doc_id: r for r in periodic_runs.find_runs(docs).collect()}
    assert [tuple(run) for run in found[1].runs] == [(1, 8, 2)]
    assert found[1].collapsed == "go a b stop"
    assert (found[2].runs, found[2].collapsed) == ([], "")


def test_very_long_text_in_the_job(odd_docs):
    longest = odd_docs.selectExpr("max(length(text))").first()[0]
    assert longest > 100_000
    assert periodic_runs.find_runs(odd_docs).count() == odd_docs.count()
