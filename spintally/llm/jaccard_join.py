"""N-gram Jaccard join and its components, by a size-aware heavy-light join.

Documents with the same set of word shingles form a class, and classes are
joined. Two classes of sizes n and m link where their sets share at least
``required(n, m)`` shingles.

Light sets, up to a boundary size: all subsets of that many shingles are
enumerated for each size a partner may have. Two sets with a subset in common
link by definition, so the sets of a subset form a star and need no comparison.

Heavy sets: the shingles of all sets that a heavy one may link with are put into
inverted lists, as far as the prefix that a partner has to meet; the lists are
scanned. Prefixes take rare shingles first: those that sets of many kinds begin with, as passages that documents
share do, come last. They are counted over all sets, among the first shingles of each (twice its
prefix, by hash); sets in which such shingles leave too few others are read again. The list of common shingles that goes to
every task has ``MOST_COMMON`` entries at most; the order is a matter of speed alone.

Lists of up to ``SHORT_LIST`` sets give all their pairs. Of the longer ones, each set is compared with a leader of
two of its lists, ``TURNS`` times, as long as a list has sets in more than one component, so
copies by the thousand take a linear number of comparisons. The pairs across components that are then left are all
compared, so no link between components is missed. Two sets may be in many lists together: a pair is passed over in a list
if one of the last ``SEEN`` of each set's lists before it is the same, as it has been met there.

Pairs are sifted before their texts are read: sizes tell a part of them, and the parity of hashed shingles
(``BITS`` bits a set) another. Each bit in which two sets differ stands for a shingle that only one
of them has, so their number bounds what they can share.

The boundary is where the cost of all subsets below it and of all lists above it,
summed over the sizes that occur, is least.

Cases: a text without words, or NULL, has an empty set and links with nothing.
Shingles are compared by 64-bit hashes, and sets are told apart by 128-bit ones. A
text shorter than a shingle is one shingle. Very long texts are read whole; their sets stay in the task
that reads them, apart from a prefix. Leaders are drawn by hash, and ties between equal sets do not arise, as these are one class. Rows are known by id and text, so NULL or repeated ids
do not mix texts; a component is named by its least non-NULL id. Empty tables give
empty results. Other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache, reduce
from itertools import combinations
from math import comb
from operator import add

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spintally.llm.components import components
from spintally.llm.text import STEP, hashed, mixed, shingles, signed
from spintally.sources.scratch import drop_ended_shuffles, handed_on, kept, scratch

# Entries of the list of common shingles, which goes to every task: 16 bytes each.
MOST_COMMON = 1 << 20
# Of 64 bits, one for each kind of set that begins with a shingle, how many make it common.
KINDS = 14
SHORT_LIST = 16
TURNS = 2
SEEN = 8
BITS = 512
# Sets of this size are carried whole.
SMALL = 64
# A list entry also costs its share of the comparisons that it leads to.
ENTRY_COST = 8
MOST_SUBSETS = 2000


def required(n: int, m: int, percent: int) -> int:
    """Least number of shared shingles: 100 * shared >= percent * (n + m - shared)."""
    return -(-percent * (n + m) // (100 + percent))


def partners(n: int, percent: int) -> range:
    """Sizes of the sets that one of size n may link with."""
    return range(-(-percent * n // 100), 100 * n // percent + 1)


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def subset_sizes(n: int, boundary: int, percent: int) -> dict[tuple[int, int], int]:
    """By pair of sizes, the size of the subsets that a light set of size n enumerates."""
    found = {}
    for m in partners(n, percent):
        shared = required(n, m, percent)
        if m <= boundary and shared <= min(n, m) and not n == m == shared:
            found[min(n, m), max(n, m)] = shared
    return found


def subset_count(n: int, boundary: int, percent: int) -> int:
    return sum(comb(n, size) for size in subset_sizes(n, boundary, percent).values())


def best_boundary(sizes: dict[int, int], percent: int) -> int:
    """The largest light size at which all subsets and list entries together cost least."""
    costs, light = {}, 0
    heavy = sum(count * prefix_length(n, percent) * ENTRY_COST for n, count in sizes.items())
    costs[0] = heavy
    n = 0
    while (n := n + 1) <= SMALL and subset_count(n, n, percent) <= MOST_SUBSETS:
        light += sizes.get(n, 0) * subset_count(n, n, percent)
        heavy -= sizes.get(n, 0) * prefix_length(n, percent) * ENTRY_COST
        costs[n] = light + heavy
    return min(costs, key=lambda n: (costs[n], -n))


def _sets(texts: Iterable[str | None], width: int) -> Iterator[np.ndarray]:
    for text in texts:
        tokens = text.encode().lower().split() if text else []
        yield shingles(hashed(tokens), width) if tokens else np.empty(0, np.uint64)


def _key(values: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(values.tobytes())


def _ids(keys: list[bytes]) -> np.ndarray:
    """The first 64 bits of the sets' hashes."""
    return np.array([int.from_bytes(key[:8], "big", signed=True) for key in keys], np.int64)


def _parity(own: np.ndarray) -> np.ndarray:
    """Whether an odd number of shingles falls on each of ``BITS`` places, as numbers of 64 bits."""
    counts = np.bincount(((own * STEP) >> np.uint64(55)).astype(np.int64), minlength=BITS)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def described(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Each document's set: size ``n``, ``key`` and ``id``; of each key's first row in a batch ``firsts`` and ``bits``.

    ``firsts`` are the set's first shingles by a mix of their hashes: all of a small set, else twice its prefix.
    """

    @F.pandas_udf("n bigint, key binary, id bigint, firsts array<bigint>, bits array<bigint>")
    def describe(texts: pd.Series) -> pd.DataFrame:
        sizes, keys, firsts, bits, seen = [], [], [], [], set()
        for own in _sets(texts, width):
            n = len(own)
            sizes.append(n)
            keys.append(key := _key(own))
            if not n or key in seen:
                firsts.append(None)
                bits.append(None)
                continue
            seen.add(key)
            place = mixed(own)
            some = n if n <= SMALL else min(n, 2 * prefix_length(n, percent))
            if some < n:
                chosen = np.argpartition(place, some)[:some]
                own, whole = own[chosen], own
                place = place[chosen]
            else:
                whole = own
            firsts.append(signed(own[np.argsort(place)]))
            bits.append(_parity(whole))
        return pd.DataFrame({"n": sizes, "key": keys, "id": _ids(keys), "firsts": firsts, "bits": bits})

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), describe("text").alias("own")).select(
        "doc_id", "text_hash", "own.*"
    )


def common_shingles(classes: DataFrame, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that sets of many kinds begin with, sorted, and a measure of how many kinds.

    A set's kind is its first shingle, which near copies mostly share. Kinds are counted as bits of a
    number, which Spark combines in each task before it shuffles.
    """
    twice = (2 * (F.col("n") - F.call_function("div", percent * F.col("n") + 99, F.lit(100)) + 1)).cast("int")
    rows = classes.select(F.get("firsts", F.lit(0)).alias("kind"), F.explode(F.slice("firsts", F.lit(1), twice)).alias("shingle"))
    kind = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.xxhash64("kind"), F.lit(64)).cast("int"))
    kinds = rows.groupBy("shingle").agg(F.bit_count(F.bit_or(kind)).alias("met")).filter(F.col("met") > KINDS)
    found = kinds.orderBy(F.desc("met"), "shingle").limit(MOST_COMMON).toPandas()
    values = found["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(values)
    return values[order], found["met"].to_numpy(np.int64)[order]


def _weights(own: np.ndarray, commons: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    common, met = commons
    if not len(common) or not len(own):
        return np.zeros(len(own), np.int64)
    at = np.minimum(np.searchsorted(common, own), len(common) - 1)
    return np.where(common[at] == own, met[at], 0)


def rarest_first(own: np.ndarray, commons: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The set in the order that all sets share."""
    return own[np.lexsort((mixed(own), _weights(own, commons)))]


ENTRIES = "id bigint, key binary, n bigint, shingles array<bigint>, subsets array<binary>"


def entries(classes: DataFrame, percent: int, boundary: int, commons) -> DataFrame:
    """List entries: ``id`` and the ``shingles`` of each set's prefix; of light sets, their ``subsets``.

    A light set takes part in the lists only if a heavy one can link with it. Sets whose prefix
    their first shingles do not tell have NULL.
    """
    shared = classes.sparkSession.sparkContext.broadcast(commons)

    def enter(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            prefixes, subsets = [], []
            for n, firsts in zip(batch["n"], batch["firsts"]):
                own, wanted = np.asarray(firsts, np.int64).view(np.uint64), 0
                if max(partners(n, percent)) > boundary:
                    wanted = prefix_length(n, percent)
                if n <= SMALL:
                    first = rarest_first(own, shared.value)[:wanted]
                else:
                    first = own[_weights(own, shared.value) == 0][:wanted]
                prefixes.append(signed(first) if len(first) == wanted else None)
                sizes = subset_sizes(n, boundary, percent) if n <= boundary else {}
                whole = np.sort(own).tolist()
                subsets.append([_subset(pair, some) for pair, k in sizes.items() for some in combinations(whole, k)])
            yield pd.DataFrame({"id": batch["id"], "key": batch["key"], "n": batch["n"], "shingles": prefixes, "subsets": subsets})

    return classes.select("id", "key", "n", "firsts").mapInPandas(enter, ENTRIES)


def whole_entries(texts: DataFrame, width: int, percent: int, commons) -> DataFrame:
    """List entries of sets that are read whole: ``id`` and ``shingles``."""
    shared = texts.sparkSession.sparkContext.broadcast(commons)

    def enter(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [rarest_first(own, shared.value)[: prefix_length(len(own), percent)] for own in _sets(batch["text"], width)]
            yield pd.DataFrame({"id": batch["id"], "shingles": list(map(signed, found))})

    return texts.select("id", "text").mapInPandas(enter, "id bigint, shingles array<bigint>")


def _subset(sizes: tuple[int, int], shingles: tuple[int, ...]) -> bytes:
    """A subset's hash, and a last byte that tells whether its sets are all of one size."""
    name = xxhash.xxh3_128_digest(np.array([*sizes, *shingles], np.uint64).tobytes())
    return name + bytes([sizes[0] == sizes[1]])


def light_links(entered: DataFrame) -> DataFrame:
    """A star for each subset that sets of both its sizes have in common.

    Sets of the two sizes link with each other, so that all are connected if
    there are both, or if the two sizes are one.
    """
    sized = entered.filter(F.size("subsets") > 0).select("key", "n", F.explode("subsets").alias("subset"))
    stars = sized.groupBy("subset").agg(F.min("key").alias("least"), F.min("n").alias("low"), F.max("n").alias("high"))
    one_size = F.substring("subset", 17, 1) == F.lit(b"\x01")
    # Written, so that the join reads plain exchanges.
    stars = kept(stars.filter(one_size | (F.col("low") < F.col("high"))).select("subset", "least"), "stars")
    joined = sized.join(stars, "subset").filter("key != least")
    return joined.select(F.col("key").alias("a"), F.col("least").alias("b")).distinct()


def _shared_lists(entered: DataFrame) -> DataFrame:
    """Entries of lists with two sets or more: ``shingle``, ``id``, ``entries``."""
    rows = entered.select("id", F.explode("shingles").alias("shingle"))
    lists = rows.groupBy("shingle").agg(F.count("*").alias("entries"), F.min("id").alias("low"), F.max("id").alias("high"))
    # Written, so that the join reads both sides from plain exchanges, whose long lists Spark can split.
    ends = kept(lists.filter("low != high").select("shingle", "entries"), "list_ends")
    drop_ended_shuffles(rows.sparkSession)
    return rows.join(ends, "shingle")


def _texts(docs: DataFrame, wanted: DataFrame, *columns: str) -> DataFrame:
    """``text`` with the classes' columns, from one document of each class that is wanted."""
    same = F.col("doc_id").eqNullSafe(F.col("own.doc_id")) & (F.xxhash64("text") == F.col("own.text_hash"))
    return docs.join(wanted.select("own", *columns), same).select("text", *columns)


def _may_link(percent: int) -> Column:
    """Whether the sizes and bits of two sets allow a link."""
    sizes = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    differing = (F.bit_count(F.get("bits_a", F.lit(i)).bitwiseXOR(F.get("bits_b", F.lit(i)))) for i in range(BITS // 64))
    most = F.col("n_a") + F.col("n_b") - reduce(add, differing)  # twice what they can share
    return sizes & ((100 + percent) * most >= 2 * percent * (F.col("n_a") + F.col("n_b")))


def _sides(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    some = classes.select("id", "key", "n", "bits")
    return tuple(
        some.withColumnsRenamed({"id": f"_{s}", "key": s, "n": f"n_{s}", "bits": f"bits_{s}"}) for s in ("a", "b")
    )


def _sifted(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs of set ids as the pairs of classes that may link."""
    a, b = _sides(classes)
    pairs = pairs.select(F.least("_a", "_b").alias("_a"), F.greatest("_a", "_b").alias("_b")).distinct()
    return pairs.join(a, "_a").join(b, "_b").filter("a != b").filter(_may_link(percent)).select("a", "b")


def _linked(pairs: DataFrame, docs: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose texts' sets are similar enough, as a written table."""

    @F.pandas_udf("boolean")
    def similar(left: pd.Series, right: pd.Series) -> pd.Series:
        # Pairs come in runs of equal texts.
        own = lru_cache(64)(lambda text: next(_sets([text], width)))
        out = []
        for a, b in zip(map(own, left), map(own, right)):
            both = len(np.intersect1d(a, b, assume_unique=True))
            out.append(100 * both >= percent * (len(a) + len(b) - both))
        return pd.Series(out, dtype=bool)

    with scratch(docs.sparkSession):
        pairs = kept(pairs, "pairs")
        named = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()
        texts = kept(_texts(docs, classes.join(named, "key"), "key").dropDuplicates(["key"]), "texts")
        drop_ended_shuffles(docs.sparkSession)
        left = texts.withColumnsRenamed({"key": "a", "text": "left"})
        right = texts.withColumnsRenamed({"key": "b", "text": "right"})
        joined = pairs.join(left, "a").join(right, "b")
        return handed_on(joined.filter(similar("left", "right")).select("a", "b"), "links")


def clusters(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``doc_id``, ``text_hash``, ``n`` and ``component``, NULL for an empty set, as a written table."""
    with scratch(docs.sparkSession):
        return handed_on(_clusters(docs.select("doc_id", "text"), width, percent), "clusters")


def _classes(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Rows with the class that each is in, and the classes."""
    with scratch(docs.sparkSession):
        rows = kept(described(docs, width, percent), "described")
        members = handed_on(rows.select("doc_id", "text_hash", "n", "key"), "members")
        classes = rows.filter("n > 0").groupBy("key").agg(
            F.first("n").alias("n"),
            F.first("id").alias("id"),
            F.min(F.struct("doc_id", "text_hash")).alias("own"),
            F.first("firsts", True).alias("firsts"),
            F.first("bits", True).alias("bits"),
        )
        return members, handed_on(classes, "classes")


def _lists(docs: DataFrame, classes: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links of light sets, and the lists that two sets or more share."""
    spark = docs.sparkSession
    counted = classes.groupBy("n").agg(F.count("*").alias("sets")).collect()  # a row for each size
    boundary = best_boundary({row.n: row.sets for row in counted}, percent)
    commons = common_shingles(classes, percent)
    drop_ended_shuffles(spark)
    with scratch(spark):
        entered = kept(entries(classes, percent, boundary, commons), "entries")
        light = handed_on(light_links(entered), "light_links")
        rows = entered.filter("shingles is not null").select("id", "shingles")
        unknown = entered.filter("shingles is null").select("key")
        if not unknown.isEmpty():
            whole = _texts(docs, classes.join(unknown, "key"), "id")
            rows = rows.union(kept(whole_entries(whole, width, percent, commons), "whole_entries"))
        return light, handed_on(_shared_lists(rows).distinct(), "lists")


def _clusters(docs: DataFrame, width: int, percent: int) -> DataFrame:
    members, classes = _classes(docs, width, percent)
    edges, lists = _lists(docs, classes, width, percent)

    def linked(met: DataFrame) -> DataFrame:
        return _linked(_sifted(met, classes, percent), docs, classes, width, percent)

    short = lists.filter(F.col("entries") <= SHORT_LIST).select("shingle", "id")
    long = lists.filter(F.col("entries") > SHORT_LIST).select("shingle", "id")
    met = short.withColumnRenamed("id", "_a").join(short.withColumnRenamed("id", "_b"), "shingle").filter("_a < _b")
    met = met.select("_a", "_b").union(_with_leaders(long.withColumn("part", F.col("id")), 0))
    edges = edges.union(linked(met))
    for turn in range(1, 1 if long.isEmpty() else TURNS + 1):
        found = kept(components(edges), "components")
        open_lists = kept(_across(long, classes, found), "open_lists")
        if open_lists.isEmpty():
            edges = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
            break
        if turn < TURNS:
            more = linked(_with_leaders(open_lists, turn))
        else:
            more = _linked(_all_across(open_lists, classes, percent), docs, classes, width, percent)
        edges = found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more)

    found = components(edges)
    return members.join(found, F.col("key") == F.col("node"), "left").select(
        "doc_id", "text_hash", "n", F.when(F.col("n") > 0, F.coalesce("component", "key")).alias("component")
    )


def _has_repeated(members: DataFrame) -> bool:
    """Whether rows repeat both id and text."""
    return not members.groupBy("doc_id", "text_hash").count().filter("count > 1").isEmpty()


def _across(long: DataFrame, classes: DataFrame, found: DataFrame) -> DataFrame:
    """Entries of long lists whose sets are in more than one component."""
    part = classes.join(found, F.col("key") == F.col("node"), "left")
    part = part.select("id", F.xxhash64(F.coalesce("component", "key")).alias("part"))
    rows = long.select("shingle", "id").join(part, "id")
    lists = rows.groupBy("shingle").agg(F.min("part").alias("least"), F.max("part").alias("most"))
    return rows.join(kept(lists.filter("least != most").select("shingle"), "open"), "shingle")


def _with_leaders(lists: DataFrame, turn: int) -> DataFrame:
    """Each set with the leaders of two of its lists, drawn anew in each turn, where they are of other components."""
    first = F.min_by(F.struct("id", "part"), F.xxhash64("id", F.lit(turn)))
    ends = kept(lists.groupBy("shingle").agg(first.alias("leader")), "leaders")
    rows = lists.join(ends, "shingle").filter("part != leader.part")
    drawn = F.struct(F.xxhash64("shingle", F.lit(turn)).alias("draw"), F.col("leader.id").alias("leader"))
    two = rows.groupBy("id").agg(F.min(drawn).alias("low"), F.max(drawn).alias("high"))
    each = two.select(F.col("id").alias("_a"), F.explode(F.array("low.leader", "high.leader")).alias("_b"))
    return each.distinct()


def _met_across(open_lists: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs of a list's sets in different components that may link, few of them more than once.

    The first list of a pair has no list before it that both are in, so each pair is met.
    """
    a, b = _sides(classes)
    earlier = Window.partitionBy("id", "part").orderBy("shingle").rowsBetween(-SEEN, -1)
    rows = open_lists.distinct().withColumn("before", F.collect_list("shingle").over(earlier))
    left = rows.withColumnsRenamed({"id": "_a", "part": "part_a", "before": "before_a"}).join(a, "_a")
    right = rows.withColumnsRenamed({"id": "_b", "part": "part_b", "before": "before_b"}).join(b, "_b")
    first = (F.col("part_a") < F.col("part_b")) & ~F.arrays_overlap("before_a", "before_b")
    joined = left.join(right, (left["shingle"] == right["shingle"]) & first & _may_link(percent))
    return joined.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _all_across(open_lists: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Those pairs, each once."""
    return _met_across(open_lists, classes, percent).distinct()


def report(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """Every document's set size, and the least id of its component."""
    found = clusters(docs, width, percent)
    least = found.filter("component is not null").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    joined = found.join(least, "component", "left")
    return joined.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents without all but one of each component: the least id, and of its rows the least text."""
    found = clusters(docs, width, percent)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "doc_id", "text")
    first = found.filter("component is not null").groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("first"))
    first = first.select(F.col("first.doc_id").alias("_id"), F.col("first.text_hash").alias("_hash"))
    empty = found.filter("component is null").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))
    named = whole.join(first.withColumn("_one", F.lit(True)).union(empty.withColumn("_one", F.lit(False))), same)
    rest = named.filter("not _one").select("doc")
    ones = named.filter("_one").select("doc", "_id", "_hash")
    if _has_repeated(found):
        ones = ones.dropDuplicates(["_id", "_hash"])
    return ones.select("doc").union(rest).select("doc.*")
