"""Quality rules with thresholds that follow each language and source.

Fixed rules come first: at least ``MIN_WORDS`` words, and no more than
``MAX_REPEATED`` percent of them in repeated five-word windows. The documents
that pass are measured, and a quantile sketch of each measure is kept for every
language and source. A document is rejected where a measure lies above its
group's upper fence, the third quartile plus ``FENCE`` times the spread between
the quartiles, or plus ``FENCE`` times ``LEAST_SPREAD`` if the spread is less.

The sketch is a histogram whose buckets keep the leading ``SKETCH_BITS`` binary
digits of a whole number, so a quantile is found within one part in 64. Sketches
merge by adding counts, in any order and with the same result: partial sums meet
in a shuffle of a few hundred cells a group, whatever the number of documents,
and the sketch of a language is the sum of those of its sources. A group of fewer
than ``MIN_GROUP`` documents takes its language's thresholds, and a small
language those of all documents.

Cases: a NULL or empty text has no words and fails the fixed rules. NULL is a
language and a source of its own. Repeated rows and ids are judged one by one,
equal rows alike. Very long texts are counted whole. Only values above a fence are rejected, never ones that are too
low: few symbols, short words or no repeats are no fault. An empty table gives an empty result. Other columns are neither
read nor changed, whatever their names. Windows are compared by 64-bit hash
within one text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spintally.llm.text import NOT_SPACES, spaced_words, window_hashes, word_digits
from spintally.sources.scratch import kept

MIN_WORDS = 10
MAX_REPEATED = 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"

FENCE = 3
MIN_GROUP = 50
SKETCH_BITS = 7
# Measures in thousandths, and the least spread that each fence allows for.
LEAST_SPREAD = {"symbols_per_word": 50, "letters_per_word": 900, "repeated_lines": 150}

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the struct ``counts`` of the fixed rules' counts, and of ``n_lines``."""
    body = F.coalesce(F.col(text), F.lit(""))
    has_word = lambda line: line.rlike(NOT_SPACES)
    df = docs.withColumn("_words", spaced_words(F.col(text)))
    df = df.withColumn("_lines", F.filter(F.split(body, "\n", -1), has_word))
    df = df.withColumn("_hashes", word_digits(F.col("_words")))
    n = F.size("_words")
    df = df.withColumn("_windows", window_hashes(F.col("_hashes"), n, WINDOW))
    # Most texts repeat no window, which needs no sort to find out.
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    pairs = F.transform("_windows", lambda hash, i: F.struct(hash.alias("hash"), i.alias("at")))
    df = df.withColumn("_sorted", F.when(repeats, F.sort_array(pairs)))
    twice = lambda pair, i: (
        (pair["hash"] == F.get(F.col("_sorted"), i + 1)["hash"])
        | (pair["hash"] == F.get(F.col("_sorted"), i - 1)["hash"])
    )
    starts = F.transform(F.filter("_sorted", lambda p, i: F.coalesce(twice(p, i), F.lit(False))), lambda p: p["at"])
    df = df.withColumn("_starts", F.sort_array(starts))
    covered = F.aggregate(
        "_starts",
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("words")),
        lambda seen, at: F.struct(
            (at + WINDOW).alias("end"),
            (seen["words"] + at + WINDOW - F.greatest(at, seen["end"])).alias("words"),
        ),
        lambda seen: seen["words"],
    )
    symbols = F.regexp_replace(body, f"[^{SYMBOLS}]+", "")
    counts = {
        "n_words": n,
        "word_chars": F.length(F.array_join("_words", "")),
        "n_symbols": F.length(symbols),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
        "n_lines": F.size("_lines"),
    }
    packed = F.struct(*[value.cast("bigint").alias(name) for name, value in counts.items()])
    # Out of a generator, so that a filter on the counts is not moved to where it works them out anew.
    df = df.withColumn("counts", F.explode(F.array(packed)))
    return df.drop("_words", "_lines", "_hashes", "_windows", "_sorted", "_starts")


def base_failed(counts: Column) -> Column:
    return (counts["n_words"] < MIN_WORDS) | (
        100 * counts["n_repeat_words"] > MAX_REPEATED * counts["n_words"]
    )


def measures(counts: Column) -> dict[str, Column]:
    """Whole thousandths; zero for a text without words."""
    per = lambda part, whole: F.when(whole > 0, F.floor(1000 * part / whole)).otherwise(0)
    return {
        "symbols_per_word": per(counts["n_symbols"], counts["n_words"]).cast("bigint"),
        "letters_per_word": per(counts["word_chars"], counts["n_words"]).cast("bigint"),
        "repeated_lines": per(counts["n_dup_lines"], counts["n_lines"]).cast("bigint"),
    }


def sketch_bucket(value: Column) -> Column:
    """The number with all but its leading binary digits set to zero."""
    shift = F.greatest(F.length(F.bin(value)) - SKETCH_BITS, F.lit(0))
    scale = F.pow(F.lit(2.0), shift).cast("bigint")
    return F.floor(value / scale).cast("bigint") * scale


def sketches(measured: DataFrame, group: tuple[str, ...]) -> DataFrame:
    """Cells of every group's sketches: ``group``, ``measure``, ``bucket``, ``docs``."""
    cells = F.array(
        *[
            F.struct(F.lit(name).alias("measure"), sketch_bucket(F.col(name)).alias("bucket"))
            for name in LEAST_SPREAD
        ]
    )
    return (
        measured.select(*group, F.explode(cells).alias("cell"))
        .groupBy(*group, "cell.measure", "cell.bucket")
        .agg(F.count("*").alias("docs"))
    )


def merged(cells: DataFrame, group: tuple[str, ...]) -> DataFrame:
    """Sketches of larger groups, from those of smaller ones."""
    return cells.groupBy(*group, "measure", "bucket").agg(F.sum("docs").alias("docs"))


def fences(cells: DataFrame, group: tuple[str, ...]) -> DataFrame:
    """One row a group: ``size``, and the upper fence of each measure."""
    own = Window.partitionBy(*group, "measure")
    ranked = cells.withColumn("size", F.sum("docs").over(own)).withColumn(
        "up_to", F.sum("docs").over(own.orderBy("bucket"))
    )
    quartile = lambda k: F.min(F.when(4 * F.col("up_to") >= k * F.col("size"), F.col("bucket")))
    found = ranked.groupBy(*group, "measure").agg(
        F.first("size").alias("size"), quartile(1).alias("low"), quartile(3).alias("high")
    )
    fence = lambda name: F.max(
        F.when(
            F.col("measure") == name,
            F.col("high") + FENCE * F.greatest(F.col("high") - F.col("low"), F.lit(LEAST_SPREAD[name])),
        )
    )
    return found.groupBy(*group).agg(
        F.first("size").alias("size"), *[fence(name).alias(f"most_{name}") for name in LEAST_SPREAD]
    )


def _joined(left: DataFrame, right: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """A left join that takes NULL keys as equal."""
    named = right.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    joined = left.join(named, reduce(Column.__and__, same, F.lit(True)), "left")
    return joined.drop(*[f"_{k}" for k in keys])


def thresholds(measured: DataFrame) -> DataFrame:
    """Fences of every language and source: its own, its language's, or everyone's."""
    cells = kept(sketches(measured, ("lang", "source")), "sketches")
    own = fences(cells, ("lang", "source"))
    by_lang = fences(merged(cells, ("lang",)), ("lang",))
    overall = fences(merged(cells, ()), ())
    names = [f"most_{name}" for name in LEAST_SPREAD]
    prefixed = lambda df, p: df.select(
        *[c for c in df.columns if c in ("lang", "source")],
        *[F.col(c).alias(f"{p}_{c}") for c in ("size", *names)],
    )
    wide = _joined(prefixed(own, "own"), prefixed(by_lang, "lang"), ("lang",))
    wide = _joined(wide.withColumn("_one", F.lit(1)), prefixed(overall, "all").withColumn("_one", F.lit(1)), ("_one",))
    pick = lambda name: (
        F.when(F.col("own_size") >= MIN_GROUP, F.col(f"own_{name}"))
        .when(F.col("lang_size") >= MIN_GROUP, F.col(f"lang_{name}"))
        .otherwise(F.col(f"all_{name}"))
    )
    return wide.select("lang", "source", *[pick(name).alias(name) for name in names])


def _verdict(counts: Column) -> Column:
    within = [
        value <= F.coalesce(F.col(f"most_{name}"), value)
        for name, value in measures(counts).items()
    ]
    return ~base_failed(counts) & reduce(Column.__and__, within)


def _measured(counted: DataFrame) -> DataFrame:
    counts = F.col("counts")
    values = [value.alias(name) for name, value in measures(counts).items()]
    return counted.filter(~base_failed(counts)).select("lang", "source", *values)


def judge(docs: DataFrame) -> DataFrame:
    """``doc_id``, the fixed rules' counts, ``base_failed`` and ``kept`` of every document."""
    counted = with_counts(docs.select("doc_id", "lang", "source", "text")).drop("text")
    counted = kept(counted, "counts")
    limits = kept(thresholds(_measured(counted)), "thresholds")
    counts = F.col("counts")
    return _joined(counted, limits, ("lang", "source")).select(
        "doc_id",
        *[counts[name].alias(name) for name in BASE],
        base_failed(counts).alias("base_failed"),
        _verdict(counts).alias("kept"),
        "lang",
        "source",
        *[f"most_{name}" for name in LEAST_SPREAD],
    )


def filter_docs(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns.

    The counts are worked out once for the sketches and once more beside the
    texts, which costs less than to move the texts to a join on ids.
    """
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "lang", "source", "text"
    )
    limits = kept(thresholds(_measured(with_counts(docs.select("lang", "source", "text")))), "thresholds")
    judged = _joined(with_counts(whole), limits, ("lang", "source"))
    return judged.filter(_verdict(F.col("counts"))).select("doc.*")
