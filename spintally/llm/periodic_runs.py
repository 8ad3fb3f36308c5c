"""Periodic runs of words by a Kruskal forest over suffixes, longest common prefix first.

A run is a stretch of words with smallest period q and a length of at least ``REPEATS`` times q and
``SHORTEST`` words, which no word beside it extends with the same period.

The suffixes of a document are sorted, with the longest common prefix (LCP) of each with the next. Neighbours are
united by decreasing LCP, in a union-find whose classes keep their positions in order. When
two classes meet at LCP l, a position p of the one and the next position p + d in both may be
newly adjacent: the words from p then repeat with period d for l + d words, and no further. If the word before p does not continue
the period, that is a run's start. No period is found twice, nor a multiple of a run's period: a smaller one would
have put a position between p and p + d at a higher LCP. A run of length L and period q
shows at LCP L - q, so unions below ``SHORTEST`` - 1 words can show none and are not made; a text without
a repeated stretch of that length is not sorted at all.

Documents are independent, so nothing is shuffled. A text of n words takes O(n log n) memory in the task
that reads it, and every text is read whole.

Cases: a NULL or empty text has no words and no runs. Words are compared exactly. Rows that repeat are each
reported. An empty table gives an empty result. Other columns are left alone.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spintally.llm.text import rolling, spaced_tokens, spaced_words

REPEATS = 4
SHORTEST = 6
# A run's words but its first period; least for a period of one word.
LEAST_LCP = SHORTEST - 1
BLOCK = 1024

RUN = ("start", "length", "period")


def word_numbers(tokens: list[bytes]) -> np.ndarray:
    """A number for each different word."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(token, len(seen)) for token in tokens), np.int64, len(tokens))


def paired(ranks: np.ndarray, width: int) -> np.ndarray:
    """Ranks of twice as many words as ``width``, from those of ``width``; a text's end comes first."""
    n = len(ranks)
    following = np.zeros(n, np.int64)
    following[: max(n - width, 0)] = ranks[width:] + 1
    return np.unique(ranks * (n + 1) + following, return_inverse=True)[1]


def repeats(words: np.ndarray) -> bool:
    """Whether a stretch of ``LEAST_LCP`` words may occur twice; equal hashes are rarely of different words."""
    windows = rolling(words.astype(np.uint64), LEAST_LCP)
    return len(np.unique(windows)) < len(windows)


def suffixes(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and the common prefix of each with the next."""
    n = len(words)
    levels, width = [words], 1
    while levels[-1].max() + 1 < n:
        levels.append(paired(levels[-1], width))
        width *= 2
    order = np.argsort(levels[-1], kind="stable")
    left, right = order[:-1].copy(), order[1:].copy()
    common = np.zeros(n - 1, np.int64)
    for ranks in reversed(levels):
        inside = (left < n) & (right < n)
        same = inside & (ranks[np.minimum(left, n - 1)] == ranks[np.minimum(right, n - 1)])
        step = same * width
        common += step
        left += step
        right += step
        width //= 2
    return order, common


class Positions:
    """An ordered set in blocks, so that no insertion moves more than one of them."""

    def __init__(self, first: int):
        self.blocks = [[first]]
        self.lasts = [first]
        self.size = 1

    def __iter__(self):
        return (position for block in self.blocks for position in block)

    def add(self, position: int) -> tuple[int | None, int | None]:
        """The neighbours that a new position gets."""
        at = min(bisect_left(self.lasts, position), len(self.blocks) - 1)
        block = self.blocks[at]
        place = bisect_left(block, position)
        before = block[place - 1] if place else self.lasts[at - 1] if at else None
        after = block[place] if place < len(block) else None
        insort(block, position)
        if len(block) > BLOCK:
            self.blocks[at : at + 1] = [block[: BLOCK // 2], block[BLOCK // 2 :]]
            self.lasts[at : at + 1] = [block[BLOCK // 2 - 1], block[-1]]
        else:
            self.lasts[at] = block[-1]
        self.size += 1
        return before, after


def runs_of(words: np.ndarray) -> list[tuple[int, int, int]]:
    """Every run as start, length and period, by start and period."""
    if not repeats(words):
        return []
    order, common = suffixes(words)
    wanted = np.flatnonzero(common >= LEAST_LCP)
    wanted = wanted[np.argsort(-common[wanted], kind="stable")]
    classes: dict[int, Positions] = {}
    parent: dict[int, int] = {}

    def root(position: int) -> int:
        while (above := parent.setdefault(position, position)) != position:
            parent[position] = position = parent[above]
        return position

    found = []
    for lcp, one, other in zip(common[wanted].tolist(), order[wanted].tolist(), order[wanted + 1].tolist()):
        one, other = root(one), root(other)
        large, small = classes.pop(one, None) or Positions(one), classes.pop(other, None) or Positions(other)
        if large.size < small.size:
            large, small, one, other = small, large, other, one
        joining = list(small)
        for i, position in enumerate(joining):
            before, after = large.add(position)
            pairs = []
            if before is not None and (i == 0 or before != joining[i - 1]):
                pairs.append((before, position))
            if after is not None and (i + 1 == len(joining) or after < joining[i + 1]):
                pairs.append((position, after))
            for start, end in pairs:
                period = end - start
                length = lcp + period
                if length < max(SHORTEST, REPEATS * period) or start and words[start - 1] == words[end - 1]:
                    continue
                found.append((start, length, period))
        parent[other] = one
        classes[one] = large
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapsed(tokens: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that are in no run, or in its first period only."""
    edges = np.zeros(len(tokens) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    dropped = np.cumsum(edges[:-1]) > 0
    return b" ".join(token for token, out in zip(tokens, dropped) if not out)


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    run = pa.struct([(name, pa.int64()) for name in RUN])
    for batch in batches:
        every, rest = [], []
        for text in batch.column("text"):
            tokens = spaced_tokens(text.as_py())
            runs = runs_of(word_numbers(tokens))
            every.append([dict(zip(RUN, one)) for one in runs])
            rest.append(collapsed(tokens, runs).decode())
        columns = [batch.column("doc_id"), pa.array(every, pa.list_(run)), pa.array(rest, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "runs", "collapsed"])


def find_runs(docs: DataFrame) -> DataFrame:
    """``doc_id``, the ``runs`` by start and period, and the ``collapsed`` text with one period of each."""
    own = docs.select("doc_id", "text")
    id_type = own.schema["doc_id"].dataType.simpleString()
    run = ", ".join(f"{name}: bigint" for name in RUN)
    return own.mapInArrow(_found, f"doc_id {id_type}, runs array<struct<{run}>>, collapsed string")


def longest(runs: Column) -> Column:
    """The run of greatest length, then smallest start and period; NULL without one."""
    key = lambda run: F.struct(
        (-run["length"]).alias("shorter"), run["start"].alias("start"), run["period"].alias("period")
    )
    return F.array_min(F.transform(runs, key))


def planted() -> Column:
    """The texts that the query reads: of a tenth of the ids, the text's end is made periodic.

    With h the CRC-32 of the id as text, g = h div 10 and n words, h divisible by ten: from word
    a = g mod n on, word i becomes word a + (i - a) mod p, where p = 1 + (n - a) div (3 + g mod 8).
    """
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.call_function("div", hashed, F.lit(10))

    def rewritten(words: Column) -> Column:
        n = F.size(words).cast("bigint")
        a = F.pmod(g, n)
        p = 1 + F.call_function("div", n - a, 3 + F.pmod(g, F.lit(8)))
        # Passed on through an array of one, as a lambda's variable is not copied for each word.
        ends = F.array(F.struct(words.alias("words"), a.alias("a"), p.alias("p")))
        place = lambda one, i: F.when(i < one["a"], i).otherwise(one["a"] + F.pmod(i - one["a"], one["p"]))
        every = lambda one: F.transform(
            F.sequence(F.lit(0).cast("bigint"), F.size(one["words"]).cast("bigint") - 1),
            lambda i: F.get(one["words"], place(one, i).cast("int")),
        )
        return F.get(F.transform(ends, every), F.lit(0))

    words = spaced_words(F.col("text"))
    chosen = (hashed % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return F.when(chosen, F.array_join(rewritten(words), " ")).otherwise(F.col("text"))


def report(docs: DataFrame) -> DataFrame:
    """Per document the number of runs, the longest, and digests of all runs and of the collapsed text."""
    found = find_runs(docs.select("doc_id", planted().alias("text"))).withColumn("one", longest(F.col("runs")))
    length, period = -F.col("one.shorter"), F.col("one.period")
    line = lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n"))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("one.start").alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.call_function("div", 1000 * length, period).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
