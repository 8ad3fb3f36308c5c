"""Quality classifier by importance resampling of hashed n-grams.

Two generative models are counted over words, word pairs and words without case and punctuation: one of the raw
text, from all documents, and one of the target, from documents labelled good and
not toxic. An n-gram's log ratio compares its count in the target with the one that the raw text lets expect;
both get a number that shrinks it, so n-grams that are seen seldom tell little. A text is cut into passages of
``CHUNK`` words and pairs, none left out; a passage's log weight is the sum over its n-grams, and a document's is
that of its worst passage. Documents are drawn without replacement in proportion to their weights by
Gumbel top-k: each log weight gets Gumbel noise, and the ``k`` largest are kept.
``k`` is the number of documents that weigh as much as all but the lightest
hundredth of the target's.

A document's own n-grams are taken out of both models before it is weighed, so that
documents of the target weigh no more than others like them, and n-grams of one document only
have log ratio 0. The target's documents are a bounded sample, the first
``TARGET_DOCS`` labelled ids by a hash; all documents are counted and scored. Noise
comes from a digest of the seed and the id, so reruns agree; log ratios are summed as whole
numbers of ``UNIT``, so their order does not matter.

Every document is weighed with each number of ``SHRINKS``. The one is taken that keeps the least part of the labelled
bad or toxic documents, as judged by one half of the labels; :func:`kept_shares` reports on the other half.
With no bad or no good label in the first half it is the largest.

N-grams go from task to task packed. Documents are dealt into batches of about ``BATCH_BYTES`` by a hash. A batch's distinct
n-grams are sorted, cut by range into shards, and sent as compressed differences with their counts; a shard's task adds up
what all batches sent and answers each with the sums, in the same order. So each task holds one batch or one shard, whose sizes
are set from counts over the whole corpus. An n-gram's hash has ``SPARE_BITS`` more than number all n-grams
of the corpus, and ``LEAST_BITS`` at least. Texts move once, for both uses of a batch.

The k-th largest key is found from histograms of a few thousand bins that narrow down, never
by sorting all keys in one place.

Cases: a NULL or empty text has log weight 0. A very long text is one batch's, as a whole. Equal keys are kept or left together.
Without labels the models are alike and all documents are kept. Empty tables give empty results.
Repeated ids share their noise; rows alike in id and text are weighed as one and given back as often as they came.
Other columns are left alone.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spintally.llm.text import LETTERS_ONLY, STEP, mixed, signed, spaced_tokens
from spintally.sources.scratch import kept

SHRINKS = (1.0, 2.0, 4.0, 16.0)
TARGET_DOCS = 20_000
LIGHTEST = 0.01
CHUNK = 256
BATCH_BYTES = 7 << 22
SHARD_GRAMS = 1 << 22
WORDS_AT_ONCE = 1 << 17
SPARE_BITS = 6
LEAST_BITS = 36
PACKING = 9
UNIT = 2.0**-20
SEED = "quality-1"
BINS = 4096


class Words(dict):
    """Numbers the words of a batch as they come, and hashes each word, and the plain words in it, once."""

    def __init__(self) -> None:
        super().__init__()
        self.hashes, self.plain, self.sizes = array("Q"), array("Q"), array("q")

    def __missing__(self, word: bytes) -> int:
        own = xxhash.xxh3_64_intdigest(word)
        self.hashes.append(own)
        if word.isalnum() and word.islower():
            self.plain.append(own)
            self.sizes.append(1)
        else:
            plain = word.translate(LETTERS_ONLY).split()
            self.plain.extend(map(xxhash.xxh3_64_intdigest, plain))
            self.sizes.append(len(plain))
        self[word] = number = len(self)
        return number

    def numbers(self, text: str | None) -> np.ndarray:
        tokens = spaced_tokens(text)
        return np.fromiter(map(self.__getitem__, tokens), np.int32, len(tokens))


def _starts(inside: np.ndarray) -> int:
    return int(np.count_nonzero(inside[:1]) + np.count_nonzero(inside[1:] & ~inside[:-1]))


def gram_count(text: bytes) -> int:
    """The number of a text's n-grams, of all kinds."""
    letters = np.frombuffer(text.translate(LETTERS_ONLY), np.uint8) != 32
    text = np.frombuffer(text, np.uint8)
    words = _starts((text != 32) & ((text < 9) | (text > 13)))
    return words + max(0, words - 1) + _starts(letters)


def passage_grams(known: Words, ids: list[np.ndarray], bits: int) -> Iterator[tuple]:
    """The n-grams of some documents at a time, as hashes of ``bits`` bits.

    Gives the first document's place, n-grams, the document of each, counted from the first one, its passage, counted likewise,
    and each document's number of passages. A document is never cut.
    """

    def kind(hashes: np.ndarray, number: int) -> np.ndarray:
        # Adding a number of its own to each kind keeps words, pairs and plain words apart; the mix carries it to all bits.
        return signed(mixed(mixed(mixed(hashes) + np.uint64(number))) >> np.uint64(64 - bits))

    hashes, plain_sizes = np.array(known.hashes, np.uint64), np.array(known.sizes, np.int64)
    words, plain = kind(hashes, 0), kind(np.array(known.plain, np.uint64), 2)
    plain_starts = np.cumsum(plain_sizes) - plain_sizes
    lengths, size = np.array([len(own) for own in ids], np.int64), CHUNK // 2
    cuts = np.flatnonzero(np.diff(np.cumsum(lengths) // WORDS_AT_ONCE, prepend=-1))
    for a, b in zip(cuts, [*cuts[1:], len(ids)]):
        own, n = np.concatenate(ids[a:b]), lengths[a:b]
        doc = np.repeat(np.arange(b - a), n)
        passages = np.maximum(1, -(-n // size))
        passage = (np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)) // size
        passage += np.repeat(np.cumsum(passages) - passages, n)
        within = np.flatnonzero(doc[1:] == doc[:-1])
        pairs = kind(hashes[own[within]] * STEP + hashes[own[within + 1]], 1)
        each = plain_sizes[own]
        index = np.repeat(plain_starts[own] - (np.cumsum(each) - each), each) + np.arange(each.sum())
        grams = np.concatenate([words[own], pairs, plain[index]])
        at = [np.concatenate([x, x[within], np.repeat(x, each)]) for x in (doc, passage)]
        yield a, grams, *at, passages


def summed(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Distinct n-grams in order, and the sums of the counts beside them."""
    grams = np.concatenate([part[0] for part in parts])
    order = np.argsort(grams)
    grams = grams[order]
    first = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]]) if len(grams) else order
    counts = (np.concatenate(own)[order] for own in list(zip(*parts))[1:])
    return [grams[first], *[np.add.reduceat(own, first) if len(own) else own for own in counts]]


def sorted_grams(known: Words, ids: list[np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of a batch in order, and where each distinct one begins."""
    sizes = np.array(known.sizes, np.int64)
    grams = np.empty(sum(len(own) + max(0, len(own) - 1) + int(sizes[own].sum()) for own in ids), np.int64)
    end = 0
    for _, found, *_ in passage_grams(known, ids, bits):
        grams[end : end + len(found)] = found
        end += len(found)
    grams.sort()
    return grams, np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]][: len(grams)])


def batch_counts(batch: pd.DataFrame, known: Words, ids: list[np.ndarray], bits: int) -> list[np.ndarray]:
    """A batch's distinct n-grams in order, with their counts in raw text and in the target.

    Each document counts once; rows alike and the target's documents, which are few, are added to that.
    """
    grams, first = sorted_grams(known, ids, bits)
    raw = np.diff(first, append=len(grams))
    grams, target = grams[first], np.zeros(len(first), np.int64)
    copies, wanted = batch["copies"].to_numpy(np.int64), batch["wanted"].to_numpy(bool)
    others = np.flatnonzero((copies > 1) | wanted)
    copies, wanted = copies[others], wanted[others]
    for a, found, doc, _, _ in passage_grams(known, [ids[i] for i in others], bits):
        own = copies[a + doc]
        found, more, own = summed([[found, own - 1, own * wanted[a + doc]]])
        at = np.searchsorted(grams, found)
        raw[at] += more
        target[at] += own
    return [grams, raw, target]


def _marked(docs: DataFrame, target: DataFrame) -> DataFrame:
    """Tells which documents are the target's, of which there are ``TARGET_DOCS`` at most."""
    marked = docs.join(F.broadcast(target.withColumn("_wanted", F.lit(True))), "doc_id", "left")
    return marked.select("doc_id", "text", F.coalesce("_wanted", F.lit(False)).alias("wanted"))


def surveyed(marked: DataFrame) -> tuple[int, int, int]:
    """Bytes of all texts, n-grams in them and in the target's."""

    def survey(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size, raw, target = 0, 0, 0
        for batch in batches:
            for text, wanted in zip(batch["text"], batch["wanted"]):
                text = (text or "").encode()
                n = gram_count(text)
                size, raw, target = size + len(text), raw + n, target + n * bool(wanted)
        yield pd.DataFrame({"size": [size], "raw": [raw], "target": [target]})

    found = marked.select("text", "wanted").mapInPandas(survey, "size bigint, raw bigint, target bigint")
    return tuple(found.agg(*[F.coalesce(F.sum(name), F.lit(0)) for name in ("size", "raw", "target")]).first())


def packed(*columns: np.ndarray, level: int = 1) -> bytes:
    """Whole numbers in columns, each byte of all of them together."""
    planes = [np.ascontiguousarray(column, "<i8").view(np.uint8).reshape(-1, 8).T.tobytes() for column in columns]
    return zstandard.compress(b"".join(planes), level)


def unpacked(blob: bytes, columns: int) -> list[np.ndarray]:
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(columns, 8, -1)
    return [np.ascontiguousarray(plane.T).view("<i8").ravel() for plane in planes]


def _texts(column: pd.Series) -> Iterator[str | None]:
    return (None if blob is None else zstandard.decompress(blob).decode() for blob in column)


def _compressed(texts: pd.Series) -> pd.Series:
    return pd.Series([None if text is None else zstandard.compress(text.encode(), PACKING) for text in texts], dtype=object)


def batched(marked: DataFrame, batches: int) -> DataFrame:
    """Each row once, with its ``copies``, its ``batch`` and its text compressed; ids as text, so that NULL changes none."""
    rows = marked.withColumn("copies", F.lit(1))
    if not marked.groupBy("doc_id").count().filter("count > 1").isEmpty():
        rows = marked.groupBy("doc_id", "text", "wanted").agg(F.count("*").cast("int").alias("copies"))
    batch = F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)).alias("batch")
    return rows.select(batch, F.col("doc_id").cast("string"), F.pandas_udf(_compressed, "binary")("text").alias("text"), "wanted", "copies")


def answered(rows: DataFrame, bits: int, shards: int) -> DataFrame:
    """For each ``batch`` and ``shard`` the corpus's ``counts``, in raw text and in the target, of the batch's n-grams, packed."""
    edges = np.array([ceil(i * 2**bits / shards) for i in range(1, shards)], np.int64)

    def sent(batch: pd.DataFrame) -> pd.DataFrame:
        known = Words()
        grams, *counts = batch_counts(batch, known, [known.numbers(text) for text in _texts(batch["text"])], bits)
        cuts = [0, *np.searchsorted(grams, edges), len(grams)]
        out = [
            (i, packed(np.diff(grams[a:b], prepend=0), *[x[a:b] for x in counts], level=PACKING)) for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b
        ]
        return pd.DataFrame(out, columns=["shard", "counts"]).assign(batch=batch["batch"].iloc[0])

    def answer(shard: pd.DataFrame) -> pd.DataFrame:
        parts = [unpacked(blob, 3) for blob in shard["counts"]]
        grams, place = np.unique(np.concatenate([np.cumsum(part[0]) for part in parts]), return_inverse=True)
        sums = [np.bincount(place, np.concatenate(x), len(grams)).astype(np.int64) for x in list(zip(*parts))[1:]]
        cuts = np.cumsum([0, *[len(part[0]) for part in parts]])
        blobs = [packed(*[total[place[a:b]] for total in sums], level=PACKING) for a, b in zip(cuts, cuts[1:])]
        return pd.DataFrame({"batch": shard["batch"], "shard": shard["shard"], "counts": blobs})

    found = rows.groupBy("batch").applyInPandas(sent, "batch bigint, shard int, counts binary")
    return found.groupBy("shard").applyInPandas(answer, "batch bigint, shard int, counts binary")


def log_ratios(raw: np.ndarray, target: np.ndarray, rate: float, shrink: float) -> np.ndarray:
    """Whole numbers of ``UNIT``."""
    return np.rint(np.log((target + shrink) / (raw * rate + shrink)) / UNIT)


def weights(marked: DataFrame) -> DataFrame:
    """Every document's log weights, one for each of ``SHRINKS``, by models that have not seen it."""
    size, raw, target = surveyed(marked)
    rate = target / raw if raw else 0.0
    bits = min(63, max(LEAST_BITS, raw.bit_length() + SPARE_BITS))
    rows = batched(marked, max(1, ceil(size / BATCH_BYTES)))
    answers = answered(rows, bits, max(1, ceil(raw / SHARD_GRAMS)))

    def score(batch: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        known = Words()
        ids = [known.numbers(text) for text in _texts(batch["text"])]
        wanted = batch["wanted"].to_numpy(bool)
        grams, first = sorted_grams(known, ids, bits)
        asked = grams[first]
        del grams, first
        parts = [unpacked(blob, 2) for blob in answers.sort_values("shard")["counts"]]
        all_raw, all_target = map(np.concatenate, zip(*parts)) if parts else [np.empty(0, np.int64)] * 2
        if len(all_raw) != len(asked):
            raise ValueError("a batch was answered for other n-grams than its own")
        found: list[list[np.ndarray]] = [[] for _ in SHRINKS]
        for a, grams, doc, passage, passages in passage_grams(known, ids, bits):
            # Each kind's n-grams come by document, and two kinds share one only where hashes collide, so a stable order is by both.
            order = np.argsort(grams, kind="stable")
            grams, doc, passage = grams[order], doc[order], passage[order]
            new = np.r_[True, (grams[1:] != grams[:-1]) | (doc[1:] != doc[:-1])][: len(grams)]
            pair, at = np.flatnonzero(new), np.cumsum(new) - 1
            own = np.diff(pair, append=len(grams))
            gram = np.searchsorted(asked, grams[pair])
            raw, target = all_raw[gram] - own, all_target[gram] - own * wanted[a + doc[pair]]
            for lists, shrink in zip(found, SHRINKS):
                sums = np.bincount(passage, log_ratios(raw, target, rate, shrink)[at], passages.sum())
                lists.append(np.minimum.reduceat(sums, np.cumsum(passages) - passages) * UNIT)
        out = {"doc_id": batch["doc_id"], "wanted": wanted, "copies": batch["copies"]}
        return pd.DataFrame(out | {f"w{i}": np.concatenate(lists) for i, lists in enumerate(found)})

    schema = "doc_id string, wanted boolean, copies int" + "".join(f", w{i} double" for i in range(len(SHRINKS)))
    found = rows.groupBy("batch").cogroup(answers.groupBy("batch")).applyInPandas(score, schema)
    each = found.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).drop("copy", "copies")
    return each.withColumn("doc_id", F.col("doc_id").cast(marked.schema["doc_id"].dataType))


def best_shrink(scored: DataFrame, labelled: DataFrame) -> int:
    """The place in ``SHRINKS`` of the one that keeps the least part of bad documents, by half the labels."""
    known = scored.join(labelled.filter(~_reported()).groupBy("doc_id").agg(F.every("good").alias("good")), "doc_id")
    names = [f"w{i}" for i in range(len(SHRINKS))]
    lightest = known.filter("good").agg(*[F.percentile_approx(name, LIGHTEST, 10_000).alias(name) for name in names]).first()
    if lightest[0] is None:
        return len(SHRINKS) - 1
    above = [F.avg((F.col(name) >= F.lit(lightest[name])).cast("int")) for name in names]
    shares = known.filter("not good").agg(*above).first()
    return max(range(len(SHRINKS)), key=lambda i: (-(shares[i] or 0.0), i))


def _reported() -> Column:
    """The half of the labels that the choice of the shrinking number does not see."""
    return F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)) == 1


def kept_shares(found: DataFrame, labels: DataFrame) -> DataFrame:
    """The part of documents kept, by label, of the labels that chose nothing."""
    known = found.join(labels.filter(_reported()).select("doc_id", "quality", "toxic"), "doc_id")
    return known.groupBy("quality", "toxic").agg(F.count("*").alias("docs"), F.avg(F.col("kept").cast("int")).alias("share"))


def kth_largest(df: DataFrame, column: str, k: int) -> float:
    """The k-th largest of a column's finite numbers, by histograms that narrow down."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    above = 0
    while low < high:
        width = (high - low) / BINS
        inside = df.filter((F.col(column) >= low) & (F.col(column) <= high))
        place = F.least(F.floor((F.col(column) - low) / width), F.lit(BINS - 1)) if width > 0 else F.lit(0)
        cells = inside.groupBy(place.alias("cell")).agg(
            F.count("*").alias("rows"), F.min(column).alias("least"), F.max(column).alias("most")
        )
        for row in sorted(cells.collect(), key=lambda row: -row.cell):  # one row a bin
            if above + row.rows >= k:
                low, high = row.least, row.most
                break
            above += row.rows
    return low


def gumbel(name: Column, seed: str = SEED) -> Column:
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(name.cast("string"), F.lit("null")))
    number = F.conv(F.substring(F.md5(named), 1, 13), 16, 10).cast("bigint")
    return -F.log(-F.log((number + F.lit(0.5)) / F.lit(2.0**52)))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document's log weight, Gumbel key, and whether it is among the k largest."""
    docs = docs.select("doc_id", "text")
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    labelled = labels.filter("quality is not null").select("doc_id", good.alias("good"))
    target = labelled.filter("good and doc_id is not null").select("doc_id").distinct()
    target = target.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TARGET_DOCS)
    target = kept(target, "target")
    marked = _marked(docs, target)
    scored = kept(weights(marked), "weights")
    weight = F.col(f"w{best_shrink(scored, labelled)}").alias("log_weight")
    scored = scored.select("doc_id", "wanted", weight, (weight + gumbel(F.col("doc_id"))).alias("key"))
    own = scored.filter("wanted")
    n = own.count()
    lightest = kth_largest(own, "log_weight", n - int(LIGHTEST * (n - 1))) if n else None
    k = scored.count() if lightest is None else scored.filter(F.col("log_weight") >= lightest).count()
    least = kth_largest(scored, "key", k) if k else float("inf")
    return scored.select("doc_id", "log_weight", "key", (F.col("key") >= F.lit(least)).alias("kept"))
