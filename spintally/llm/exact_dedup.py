"""Exact dedup by skew-safe combining: locally, by salted digest, then across salts.

Texts are equal if they are identical without their white space (``normalised``). Of equal
texts the row with the most code points stays, of these the one with the smallest id.

Each step groups by digest *and* content, so contents are compared byte for byte at every step and a
digest alone never decides. Every task first reduces its own rows to one a content. These go
to one of ``SALTS`` groups of their digest, by the task they come from, so that no task gets all the
rows of a text that a third of the table repeats; the salts' winners, ``SALTS`` at most a content, are then
combined across the table.

Documents find their winner by digest alone, without their texts, wherever a digest has one content, which the last
step has made sure of. Where a digest has several, they find it by content. Contents that hold more
than one in ``HOT_SHARE`` of all rows are at most ``HOT_SHARE`` many, whatever the table's size: only
these are broadcast, and every other key of that join has few rows.

Cases: a NULL text counts as empty, and empty texts are equal to each other and to those of white space alone. A
NULL id comes after all others. Rows that repeat id and text each count; all of them are
marked as kept if they are the ones that stay, and :func:`one_of_each` returns one of them. Very long texts
are compared whole. An empty table gives an empty result. Other columns are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spintally.sources.scratch import kept

# Fixed value: what the comparison leaves out.
SPACE_CHARACTERS = "\x20\x09\x0a\x0b\x0c\x0d"

SALTS = 16
HOT_SHARE = 1000
DIGEST_CHARS = 64


def normalised(text: Column) -> Column:
    """The text without white space; empty for NULL."""
    return F.translate(F.coalesce(text, F.lit("")), SPACE_CHARACTERS, "")


def _characters() -> Column:
    return F.length(F.coalesce("text", F.lit(""))).cast("bigint")


def _digest(body: Column, chars: int) -> Column:
    return F.substring(F.sha2(body, 256), 1, chars)


def winners(docs: DataFrame, digest_chars: int = DIGEST_CHARS) -> DataFrame:
    """A row a content: ``digest``, ``keep_id``, ``keep_n`` (its code points), ``group_size``, ``contents``, ``body``.

    ``contents`` is the number of contents that the digest has, and ``body`` the content where it has several.
    """
    best = F.struct((-_characters()).alias("less"), F.col("doc_id").isNull().alias("unnamed"), "doc_id")
    salt = F.pmod(F.spark_partition_id(), F.lit(SALTS))
    rows = docs.select(normalised(F.col("text")).alias("body"), best.alias("best"), salt.alias("salt"))
    rows = rows.withColumn("digest", _digest(F.col("body"), digest_chars))
    # Spark combines the rows of a task before it shuffles them: that is the local step.
    salted = rows.groupBy("digest", "salt", "body").agg(F.min("best").alias("best"), F.count("*").alias("size"))
    whole = salted.repartition("digest").groupBy("digest", "body")
    whole = whole.agg(F.min("best").alias("best"), F.sum("size").alias("group_size"))
    contents = F.count("*").over(Window.partitionBy("digest"))
    return whole.withColumn("contents", contents).select(
        "digest",
        F.col("best.doc_id").alias("keep_id"),
        (-F.col("best.less")).alias("keep_n"),
        "group_size",
        "contents",
        F.when(F.col("contents") > 1, F.col("body")).alias("body"),
    )


def _by_digest(own: DataFrame, found: DataFrame) -> DataFrame:
    """``own`` with its winner, where no key but the broadcast ones has more than its share of rows."""
    total = found.agg(F.sum("group_size")).first()[0] or 0
    is_hot = F.col("group_size") * HOT_SHARE > total
    hot = F.broadcast(found.filter(is_hot))
    rest = own.join(hot, "digest", "left_anti")
    return own.join(hot, "digest").unionByName(rest.join(found.filter(~is_hot), "digest"))


def judge(docs: DataFrame, digest_chars: int = DIGEST_CHARS) -> DataFrame:
    """Per row ``doc_id``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` of the normalised text.

    ``digest_chars`` shortens the digest that groups are dealt by, not the one returned.
    """
    docs = docs.select("doc_id", "text")
    found = kept(winners(docs, digest_chars), "winners")
    body = normalised(F.col("text"))
    own = docs.select("doc_id", _characters().alias("n"), F.sha2(body, 256).alias("text_sha256"))
    own = kept(own, "digests").withColumn("digest", F.substring("text_sha256", 1, digest_chars))
    shared = found.filter("contents > 1")
    joined = _by_digest(own, found.filter("contents = 1").drop("contents", "body"))
    if not shared.isEmpty():
        texts = docs.select("doc_id", _characters().alias("n"), body.alias("body"))
        texts = texts.withColumns({"text_sha256": F.sha2("body", 256), "digest": _digest(F.col("body"), digest_chars)})
        by_text = texts.join(shared.drop("contents"), ["digest", "body"]).drop("body")
        joined = joined.unionByName(by_text)
    stays = (F.col("n") == F.col("keep_n")) & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return joined.select("doc_id", "keep_id", "group_size", stays.alias("kept"), "text_sha256")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns."""
    found = kept(winners(docs.select("doc_id", "text")), "winners").select(
        F.col("digest").alias("_digest"), F.col("keep_id").alias("_keep_id"), F.col("keep_n").alias("_keep_n"), F.col("body").alias("_content")
    )
    rows = docs.select(F.struct("*").alias("_row"), normalised(F.col("text")).alias("_body"), _characters().alias("_n"))
    rows = rows.withColumn("_digest", _digest(F.col("_body"), DIGEST_CHARS))
    same = (F.col("_n") == F.col("_keep_n")) & F.col("_row.doc_id").eqNullSafe(F.col("_keep_id"))
    same &= F.coalesce("_content", "_body") == F.col("_body")
    stays = rows.join(found.withColumnRenamed("_digest", "_of"), same & (F.col("_digest") == F.col("_of")), "left_semi")
    return stays.dropDuplicates(["_digest", "_body"]).select("_row.*")
