"""Substring dedup by relative Lempel-Ziv parsing.

The reference is every window of ``WINDOW`` words that may repeat, once, at its first place in order of documents and
places. It is cut by hash into blocks, each indexed by one task, and every document is looked up in every
block that can hold a window of its. As a window stands once in the reference, the longest match at a word is the chain of
windows whose places there follow each other. The parse is greedy: from left to right, the longest match of ``WINDOW`` words
or more that starts earlier becomes a factor, copied from one place, and the parse goes on behind it; where there is none, the
word stands for itself. A greedy parse by itself misses windows that lie across the end of a factor. So where the next factor does not
begin there, the last window across the end that starts earlier is added, as a factor ``across`` it. The words of factors are
removed; these are all words of all windows that occur earlier.

Most windows occur once, and are never indexed. Each window has a seed, the least hash of its runs of
``SEED`` words; equal windows have equal seeds, and windows side by side mostly share theirs, so seeds are a
seventh of the windows. Only windows of seeds that occur twice or more, over all documents, are looked up.

Documents are dealt into batches of about ``BATCH_BYTES`` by a hash. A batch sends each seed and each window once, sorted,
cut by range and packed, so that no task gets all copies of a hot passage, and is answered in the same order. So each
task holds one batch or one block, whose numbers come from a count over the corpus. Texts move once a job, of which there are two.

Cases: order is by id, NULL last, then by a hash of the text if ids repeat, then by place. Rows that repeat id
and text are one document and keep the same words. A NULL or empty text has no words; a very long one is one batch's, as a whole.
Windows are compared by 128-bit hashes. Empty tables give empty results. Other columns are left alone.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spintally.llm.quality_classifier import packed, summed, unpacked
from spintally.llm.text import hashed, rolling, signed, spaced_tokens
from spintally.sources.scratch import kept

WINDOW = 20
SEED = 8
PER_SEED = WINDOW - SEED + 1
OTHER_STEP = np.uint64(0xD1B54A32D192ED03)
BATCH_BYTES = 1 << 24
BLOCK_WINDOWS = 1 << 22
# A shard has a fourth of a block's rows, as a batch sends most of its seeds and few of its windows.
SHARDS_A_BLOCK = 4
SPARE_BITS = 6
LEAST_BITS = 36
BLANKS = " \t\n\v\f\r"
PLACES = ["lost", "id", "th", "at"]


def seed_runs(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seeds, and the windows of each as first place * 16 + number - 1."""
    n = len(words) - WINDOW + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    seeds = rolling(words, SEED)
    views = np.lib.stride_tricks.sliding_window_view(seeds, PER_SEED)
    anchors = np.arange(n) + views.argmin(axis=1)
    first = np.flatnonzero(np.r_[True, anchors[1:] != anchors[:-1]])
    return seeds[anchors[first]], first * 16 + np.diff(np.r_[first, n]) - 1


def in_runs(runs: np.ndarray) -> np.ndarray:
    """All places of the runs' windows."""
    starts, counts = runs >> 4, (runs & 15) + 1
    skips = np.repeat(starts - (np.cumsum(counts) - counts), counts)
    return skips + np.arange(counts.sum())


def seed_shards(words: int) -> int:
    """Into how many shards seeds are cut; about two in ``PER_SEED + 1`` words begin a run of another seed."""
    return max(1, ceil(2 * words * SHARDS_A_BLOCK / (PER_SEED + 1) / BLOCK_WINDOWS))


def surveyed(docs: DataFrame) -> tuple[int, int]:
    """Bytes of all texts, and a number that their words do not exceed."""
    blanks = F.length("text") - F.length(F.translate("text", BLANKS, ""))
    sums = [F.sum(F.octet_length("text")), F.sum(blanks + 1)]
    return tuple(docs.agg(*[F.coalesce(total, F.lit(0)) for total in sums]).first())


def _compressed(texts: pd.Series) -> pd.Series:
    return pd.Series([zstandard.compress((text or "").encode(), 5) for text in texts], dtype=object)


def batched(docs: DataFrame, batches: int) -> DataFrame:
    """Each document once, with its ``copies``, its ``batch`` and its text compressed; ``th`` tells texts of one id apart where ids repeat."""
    rows = docs.select(F.isnull("doc_id").alias("lost"), F.coalesce("doc_id", F.lit(0)).cast("bigint").alias("id"), "text")
    if rows.groupBy("lost", "id").count().filter("count > 1").isEmpty():
        rows = rows.withColumns({"copies": F.lit(1).cast("bigint"), "th": F.lit(0).cast("bigint")})
    else:
        rows = rows.groupBy("lost", "id", "text").agg(F.count("*").alias("copies")).withColumn("th", F.xxhash64("text"))
    batch = F.pmod(F.xxhash64("lost", "id", "th"), F.lit(batches)).alias("batch")
    return rows.select(batch, "lost", "id", "th", "copies", F.pandas_udf(_compressed, "binary")("text").alias("text"))


def _words(batch: pd.DataFrame) -> list[np.ndarray]:
    return [hashed(zstandard.decompress(blob).split()) for blob in batch["text"]]


def _seeds(words: list[np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The documents' seeds as hashes of ``bits`` bits, their runs, and the document of each."""
    found = [seed_runs(own) for own in words]
    seeds, runs = (np.concatenate(part) for part in zip(*found))
    return signed(seeds >> np.uint64(64 - bits)), runs, np.repeat(np.arange(len(found)), [len(own) for own, _ in found])


def repeated_seeds(rows: DataFrame, bits: int, shards: int) -> DataFrame:
    """For each ``batch`` and ``shard`` which of the batch's distinct seeds occur twice or more, as ``bits``."""
    edges = np.array([ceil(i * 2**bits / shards) for i in range(1, shards)], np.int64)

    def sent(batch: pd.DataFrame) -> pd.DataFrame:
        seeds = _seeds(_words(batch), bits)[0]
        seeds, times = summed([[seeds, np.ones(len(seeds), np.int64)]])
        cuts = [0, *np.searchsorted(seeds, edges), len(seeds)]
        out = [(i, packed(np.diff(seeds[a:b], prepend=0), times[a:b])) for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
        return pd.DataFrame(out, columns=["shard", "seeds"]).assign(batch=batch["batch"].iloc[0])

    def answer(shard: pd.DataFrame) -> pd.DataFrame:
        parts = [unpacked(blob, 2) for blob in shard["seeds"]]
        cuts = np.cumsum([0, *[len(part[0]) for part in parts]])
        seeds, times = np.concatenate([np.cumsum(part[0]) for part in parts]), np.concatenate([part[1] for part in parts])
        del parts
        order = np.argsort(seeds)
        seeds = seeds[order]
        first = np.flatnonzero(_new(seeds))
        del seeds
        often = np.empty(len(order), bool)
        often[order] = np.repeat(np.add.reduceat(times[order], first) > 1, np.diff(first, append=len(order)))
        del order, times
        blobs = [np.packbits(often[a:b]).tobytes() for a, b in zip(cuts, cuts[1:])]
        return pd.DataFrame({"batch": shard["batch"], "shard": shard["shard"], "n": np.diff(cuts), "bits": blobs})

    found = rows.groupBy("batch").applyInPandas(sent, "batch bigint, shard int, seeds binary")
    return found.groupBy("shard").applyInPandas(answer, "batch bigint, shard int, n bigint, bits binary")


class Looked:
    """A batch's windows of repeated seeds, in order of documents and places.

    ``doc`` and ``at`` tell where each stands, and ``kind`` which of the batch's distinct ones it is; these are in order of their
    hashes ``one`` and ``two``, and ``first`` is the first window of each.
    """

    def __init__(self, batch: pd.DataFrame, often: pd.DataFrame, bits: int) -> None:
        self.batch = batch.sort_values(["lost", "id", "th"], ignore_index=True)
        words = _words(self.batch)
        seeds, runs, doc = _seeds(words, bits)
        asked, place = np.unique(seeds, return_inverse=True)
        answers = often.sort_values("shard")
        flags = [np.unpackbits(np.frombuffer(blob, np.uint8), count=n) for blob, n in zip(answers["bits"], answers["n"])]
        flags = np.concatenate([np.empty(0, np.uint8), *flags])
        if len(flags) != len(asked):
            raise ValueError("a batch was answered for other seeds than its own")
        chosen = flags[place] > 0
        runs, doc = runs[chosen], doc[chosen]
        self.doc, self.at = np.repeat(doc, (runs & 15) + 1), in_runs(runs)
        ends = np.searchsorted(self.doc, np.arange(len(words) + 1))
        places = [self.at[a:b] for a, b in zip(ends, ends[1:])]
        one, two = (
            np.concatenate([rolling(own, WINDOW, *step)[at] for own, at in zip(words, places)]) for step in ((), (OTHER_STEP,))
        )
        order = np.lexsort((two, one))
        one, two = one[order], two[order]
        new = _new(one, two)
        self.kind = np.empty(len(order), np.int64)
        self.kind[order] = np.cumsum(new) - 1
        self.one, self.two, self.first = one[new], two[new], order[new]

    def places(self, windows: np.ndarray) -> list[np.ndarray]:
        """The order of these windows' documents, and their places in them."""
        own = [self.batch[name].to_numpy(np.int64)[self.doc[windows]] for name in PLACES[:3]]
        return [*own, self.at[windows]]


def _new(*columns: np.ndarray) -> np.ndarray:
    """Which rows of sorted columns differ from the one before."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([column[1:] != column[:-1] for column in columns])
    return new


def first_places(rows: DataFrame, often: DataFrame, bits: int, blocks: int) -> DataFrame:
    """For each ``batch`` and ``block`` the places in the reference of the batch's windows.

    They are told as differences from the window's first place in the batch, so that those that are there already are all zeros.
    """
    edges = np.array([ceil(i * 2**64 / blocks) for i in range(1, blocks)], np.uint64)

    def sent(batch: pd.DataFrame, often: pd.DataFrame) -> pd.DataFrame:
        own = Looked(batch, often, bits)
        columns = [signed(own.two), *own.places(own.first)]
        cuts = [0, *np.searchsorted(own.one, edges), len(own.one)]
        out = [
            (i, packed(signed(np.diff(own.one[a:b], prepend=np.uint64(0))), *[column[a:b] for column in columns]))
            for i, (a, b) in enumerate(zip(cuts, cuts[1:]))
            if a < b
        ]
        return pd.DataFrame(out, columns=["block", "windows"]).assign(batch=batch["batch"].iloc[0])

    def answer(block: pd.DataFrame) -> pd.DataFrame:
        parts = [unpacked(blob, 6) for blob in block["windows"]]
        sizes = [len(part[0]) for part in parts]
        one = np.concatenate([np.cumsum(part[0]) for part in parts])
        two, *places = (np.concatenate([part[i] for part in parts]) for i in range(1, 6))
        del parts
        order = np.lexsort((*places[::-1], two, one))
        new = _new(one[order], two[order])
        del one, two
        source = np.empty(len(order), np.int64)
        source[order] = order[new][np.cumsum(new) - 1]
        cuts = np.cumsum([0, *sizes])
        moves = [place[source] - place for place in places]
        blobs = [packed(*[move[a:b] for move in moves]) for a, b in zip(cuts, cuts[1:])]
        return pd.DataFrame({"batch": block["batch"], "block": block["block"], "sources": blobs})

    found = rows.groupBy("batch").cogroup(often.groupBy("batch")).applyInPandas(sent, "batch bigint, block int, windows binary")
    return found.groupBy("block").applyInPandas(answer, "batch bigint, block int, sources binary")


def greedy(at: np.ndarray, last: np.ndarray) -> list[tuple[int, int, bool]]:
    """Factors of a document as window number, end, and whether it lies across another's end.

    ``at`` has the places of windows that start earlier, in order, and ``last`` the last one of each window's chain.
    """
    found = []
    i = 0
    while i < len(at):
        end = int(last[i]) + WINDOW
        found.append((i, end, False))
        after = int(np.searchsorted(at, end))
        across = after - 1
        if at[across] > last[i] and (after == len(at) or at[after] > end):
            found.append((across, int(at[across]) + WINDOW, True))
        i = after
    return found


def _parsed(batch: pd.DataFrame, often: pd.DataFrame, sources: pd.DataFrame, bits: int) -> pd.DataFrame:
    """Every document's factors, and its words without them."""
    looked = Looked(batch, often, bits)
    moves = [unpacked(blob, 4) for blob in sources.sort_values("block")["sources"]]
    moves = [np.concatenate(column) for column in zip(*moves)] if moves else [np.empty(0, np.int64)] * 4
    if len(moves[0]) != len(looked.one):
        raise ValueError("a batch was answered for other windows than its own")
    source = [(own + move)[looked.kind] for own, move in zip(looked.places(looked.first), moves)]
    here = looked.places(np.arange(len(looked.at)))
    earlier = np.logical_or.reduce([a != b for a, b in zip(source, here)])
    doc, at, *source = (column[earlier] for column in (looked.doc, looked.at, *source))
    step = [np.diff(column) for column in (doc, at, *source)]
    goes_on = (step[0] == 0) & (step[1] == 1) & (step[5] == 1) & (step[2] == 0) & (step[3] == 0) & (step[4] == 0)
    chain = np.r_[0, np.cumsum(~goes_on)][: len(at)]
    last = at[np.searchsorted(chain, chain, "right") - 1]
    ends = np.searchsorted(doc, np.arange(len(looked.batch) + 1))
    out = []
    for blob, a, b in zip(looked.batch["text"], ends, ends[1:]):
        tokens = zstandard.decompress(blob).split()
        found = greedy(at[a:b], last[a:b])
        windows = np.array([i for i, _, _ in found], np.int64) + a
        stops = np.array([end for _, end, _ in found], np.int64)
        edges = np.zeros(len(tokens) + 1, np.int64)
        np.add.at(edges, at[windows], 1)
        np.add.at(edges, stops, -1)
        removed = np.cumsum(edges[:-1]) > 0
        rest = b" ".join([token for token, gone in zip(tokens, removed) if not gone] if found else tokens)
        lost, id, _, place = (column[windows] for column in source)
        out.append((len(tokens), int(removed.sum()), rest.decode(), at[windows], stops, lost, id, place, [across for _, _, across in found]))
    names = ["n_words", "n_removed", "kept_text", "starts", "ends", "source_lost", "source_ids", "source_starts", "across"]
    return pd.concat([looked.batch[["lost", "id", "copies"]], pd.DataFrame(out, columns=names)], axis=1)


def dedup(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, the ``kept_text`` and the ``factors`` taken out.

    A factor's words ``start`` to ``end``, exclusive, are those of document ``source_id`` from ``source_start`` on;
    ``across`` tells those that a greedy parse by itself would not have. Factors overlap only there.
    """
    size, words = surveyed(docs)
    bits = min(63, max(LEAST_BITS, words.bit_length() + SPARE_BITS))
    rows = batched(docs, max(1, ceil(size / BATCH_BYTES)))
    often = kept(repeated_seeds(rows, bits, seed_shards(words)), "seeds")
    sources = first_places(rows, often, bits, max(1, ceil(words / BLOCK_WINDOWS)))
    answers = often.select("batch", "shard", "n", "bits", F.lit(None).cast("int").alias("block"), F.lit(None).cast("binary").alias("sources"))
    answers = answers.unionByName(sources, allowMissingColumns=True)

    def parse(batch: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        about_seeds = answers["shard"].notna()
        often = answers[about_seeds].astype({"shard": "int64", "n": "int64"})
        return _parsed(batch, often, answers[~about_seeds], bits)

    found = rows.groupBy("batch").cogroup(answers.groupBy("batch")).applyInPandas(
        parse,
        "lost boolean, id bigint, copies bigint, n_words bigint, n_removed bigint, kept_text string, starts array<bigint>,"
        " ends array<bigint>, source_lost array<bigint>, source_ids array<bigint>, source_starts array<bigint>, across array<boolean>",
    )
    each = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")))
    factor = lambda of: F.struct(
        of.starts.alias("start"),
        of.ends.alias("end"),
        F.when(of.source_lost == 0, of.source_ids).alias("source_id"),
        of.source_starts.alias("source_start"),
        of.across.alias("across"),
    )
    zipped = F.arrays_zip("starts", "ends", "source_lost", "source_ids", "source_starts", "across")
    doc_id = F.when(~F.col("lost"), F.col("id")).alias("doc_id")
    return each.select(doc_id, "n_words", "n_removed", "kept_text", F.transform(zipped, factor).alias("factors"))


def report(docs: DataFrame) -> DataFrame:
    """Per document the words removed, and a digest of those kept."""
    done = dedup(docs)
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"), "factors")
