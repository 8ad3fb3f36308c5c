"""Finding benchmark passages in documents, as a prefix-filtered set join.

An item's windows are its runs of ``WINDOW`` words, or the whole of a shorter
item. A window is contained in a text where all its shingles of ``SHINGLE`` words
are, so the shortest necessary prefix of its shingles, ordered by rarity, is its
rarest one. Rarity is counted over all documents: one pass looks every shingle of
the texts up among those of the benchmark and keeps the few that are found. The
rarest shingle of each window is then joined with these, its place in the window
bounds where the window can start and end in the text, and the words there are
compared one by one. What the join carries is as long as the places found, not
as the texts.

The benchmark's side of a join is a written table, so Spark broadcasts it if it
is small and shuffles both sides if it is not.

Cases: a NULL or empty text has no words and no windows, as document and as
item. Equal windows of several items are looked for once. A document id is looked
up together with a hash of its text, so ids that are NULL or repeated do not mix
texts. Empty tables give an empty result, or one without hits. Other columns are
left alone, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spintally.llm.text import letter_words, window_hashes, word_digits
from spintally.sources.scratch import kept

WINDOW = 10
SHINGLE = 3


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """``item_id``, ``window`` and ``words`` of every window of every item."""
    words = benchmark.select("item_id", letter_words(F.col("text")).alias("words"))
    words = words.filter(F.size("words") > 0)
    last = F.greatest(F.size("words") - WINDOW, F.lit(0))
    starts = words.select("item_id", "words", F.explode(F.sequence(F.lit(0), last)).alias("at"))
    window = F.slice("words", F.col("at") + 1, WINDOW)
    return starts.select("item_id", window.alias("words")).distinct().select(
        "item_id", F.sha2(F.array_join("words", " "), 256).alias("window"), "words"
    )


def window_shingles(windows: DataFrame) -> DataFrame:
    """``window``, ``words``, and each shingle's ``hash``, ``width`` and place ``at``."""
    distinct = windows.select("window", "words").dropDuplicates(["window"])
    size = F.size("words")
    places = distinct.withColumn("width", F.least(size, F.lit(SHINGLE))).withColumn(
        "at", F.explode(F.sequence(F.lit(0), size - F.least(size, F.lit(SHINGLE))))
    )
    shingle = F.slice("words", F.col("at") + 1, F.col("width"))
    return places.withColumn("hash", F.xxhash64(word_digits(shingle)))


def document_shingles(docs: DataFrame, widths: list[int]) -> DataFrame:
    """``doc_id``, ``text_hash``, and each shingle's ``hash`` and place ``at``."""
    words = letter_words(F.col("text"))
    df = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words.alias("words"))
    df = df.select("doc_id", "text_hash", F.size("words").alias("n"), word_digits(F.col("words")).alias("digits"))
    found = [
        df.select(
            "doc_id", "text_hash", F.posexplode(window_hashes(F.col("digits"), F.col("n"), width)).alias("at", "hash")
        )
        for width in widths
    ]
    return reduce(DataFrame.unionAll, found)


def occurrences(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """Places that may hold a window: ``doc_id``, ``text_hash``, ``start``, ``window``, ``words``."""
    shingles = kept(window_shingles(windows), "shingles")
    wanted = kept(shingles.select("hash").distinct(), "wanted")
    widths = sorted(row.width for row in shingles.select("width").distinct().collect())
    if not widths:
        id_type = docs.schema["doc_id"].dataType.simpleString()
        schema = f"doc_id {id_type}, text_hash bigint, start int, window string, words array<string>"
        return docs.sparkSession.createDataFrame([], schema)
    found = kept(document_shingles(docs, widths).join(wanted, "hash"), "found")
    rarity = found.groupBy("hash").agg(F.count("*").alias("often"))
    prefix = (
        shingles.join(rarity, "hash", "left")
        .groupBy("window")
        .agg(
            F.min(F.struct(F.coalesce("often", F.lit(0)).alias("often"), "hash", "at")).alias("rarest"),
            F.first("words").alias("words"),
        )
        .filter("rarest.often > 0")
        .select("window", "words", F.col("rarest.hash").alias("hash"), F.col("rarest.at").alias("offset"))
    )
    prefix = kept(prefix, "prefixes")
    start = F.col("at") - F.col("offset")
    return (
        found.join(prefix, "hash")
        .filter(start >= 0)
        .select("doc_id", "text_hash", start.alias("start"), "window", "words")
    )


def verified(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every document with its words and the windows that occur in it, and the items of the windows."""
    windows = kept(benchmark_windows(benchmark), "windows")
    places = occurrences(docs, windows).groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.struct("start", "window", "words")).alias("places")
    )
    places = places.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    hash = F.xxhash64("text")
    joined = docs.join(places, docs["doc_id"].eqNullSafe(F.col("_id")) & (hash == F.col("_hash")), "left")
    counted = joined.withColumn("_words", letter_words(F.col("text")))
    same = lambda place: (
        F.slice("_words", place["start"] + 1, F.size(place["words"])) == place["words"]
    )
    # Out of a generator, so that a filter on the places is not moved to where it splits texts anew.
    return counted.withColumn("_places", F.explode(F.array(F.filter("places", same)))), windows


def _covered(places: Column) -> Column:
    """Words in the union of all windows' places."""
    spans = F.sort_array(
        F.transform(places, lambda p: F.struct(p["start"].alias("at"), (p["start"] + F.size(p["words"])).alias("end")))
    )
    return F.aggregate(
        spans,
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("words")),
        lambda seen, span: F.struct(
            F.greatest(seen["end"], span["end"]).alias("end"),
            (seen["words"] + F.greatest(span["end"] - F.greatest(span["at"], seen["end"]), F.lit(0))).alias("words"),
        ),
        lambda seen: seen["words"],
    )


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document its words, hit words, and the items whose windows occur in it."""
    checked, windows = verified(docs.select("doc_id", "text"), benchmark)
    judged = checked.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        F.size("_words").cast("bigint").alias("n_words"),
        F.coalesce(_covered(F.col("_places")), F.lit(0)).cast("bigint").alias("n_hit"),
        F.array_distinct(F.transform("_places", lambda p: p["window"])).alias("hits"),
    )
    judged = kept(judged, "judged")
    items = (
        judged.filter("n_hit > 0")
        .select("doc_id", "text_hash", F.explode("hits").alias("window"))
        .join(windows.select("window", "item_id"), "window")
        .groupBy("doc_id", "text_hash")
        .agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
        .withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    joined = judged.join(items, same, "left")
    return joined.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def clean_docs(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no window occurs, with all their columns."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "doc_id", "text")
    checked, _ = verified(whole, benchmark)
    return checked.filter(F.coalesce(F.size("_places"), F.lit(0)) == 0).select("doc.*")
