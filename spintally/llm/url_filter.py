"""URL filter: rules by host and path, and a model for the urls that no rule fits.

A rule fits its host and all subdomains where the path starts with the rule's; the
longest fitting rule decides. All other urls are judged by a logistic regression on
hashed character n-grams of host and path. It is trained from a small labelled
table: hosts to block, made of pairs of ``BLOCK_WORDS``, against urls of the table
whose hosts hold none of these words, the first ``TRAINING_URLS`` distinct ones by a
hash, so that the sample is the same in every run and bounded whatever the table's size. Both
classes have the same paths, so paths without meaning weigh nothing.

Cases: a NULL url, or one without ``://``, has empty host and path and is judged
by the model from these. Repeated urls are judged alike. Without urls to learn from the
model allows all. Empty tables give empty results. Other columns are left alone.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spintally.llm.text import UPPER

# Host and path together, with the verdict.
RULES = {
    "com/": "allow",
    "example.com/en/": "block",
    "www.example.com/en/": "allow",
    "net/es/": "block",
    "net/fr/": "block",
}

# Words that name hosts to block, in the labelled table.
BLOCK_WORDS = (
    "ads", "adult", "bet", "bonus", "casino", "cheap", "click", "farm", "loan", "malware",
    "pills", "poker", "popup", "slots", "spam", "track", "warez", "win", "xxx",
)

TRAINING_URLS = 5000
FEATURES = 1 << 16
WIDTHS = (3, 4, 5)
STEPS = 200
LEARNING_RATE = 4.0
DECAY = 1e-4


def with_parts(pages: DataFrame) -> DataFrame:
    """Adds ``host`` in small letters and ``path``, both empty without ``://``."""
    rest = F.regexp_extract("url", r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), UPPER, UPPER.lower())
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return pages.withColumn("host", F.coalesce(host, F.lit(""))).withColumn("path", F.coalesce(path, F.lit("")))


def longest_rule(rules: dict[str, str]) -> Column:
    """The longest rule that fits ``host`` and ``path``, else NULL."""
    fitting = []
    for rule in sorted(rules, key=len, reverse=True):
        host, slash, path = rule.partition("/")
        own = (F.col("host") == host) | F.col("host").endswith(f".{host}")
        fitting.append(F.when(own & F.col("path").startswith(slash + path), F.lit(rule)))
    return F.coalesce(*fitting, F.lit(None).cast("string"))


def ngrams(text: Column, salt: str) -> Column:
    """Hashed n-grams of a text between borders, distinct."""
    bordered = F.concat(F.lit("^"), text, F.lit("$"))
    lists = []
    for width in WIDTHS:
        starts = F.sequence(F.lit(1), F.length(bordered) - width + 1)
        hashed = F.transform(starts, lambda at, w=width: F.pmod(F.xxhash64(F.lit(salt), F.substring(bordered, at, w)), F.lit(FEATURES)))
        lists.append(F.when(F.length(bordered) >= width, hashed).otherwise(F.array().cast("array<bigint>")))
    return F.array_distinct(F.concat(*lists))


def features() -> Column:
    return F.concat(ngrams(F.col("host"), "host"), ngrams(F.col("path"), "path")).cast("array<int>")


def labelled(parts: DataFrame) -> DataFrame:
    """``host``, ``path`` and ``blocked`` of the small labelled table."""
    words = [F.col("host").contains(word) for word in BLOCK_WORDS]
    ordinary = parts.filter(~reduce(Column.__or__, words) & (F.col("host") != "")).select("host", "path").distinct()
    ordinary = ordinary.orderBy(F.xxhash64("host", "path"), "host", "path").limit(TRAINING_URLS)
    allowed = [(row.host, row.path) for row in ordinary.collect()]
    domains = sorted({host.split(".")[-1] for host, _ in allowed}) or ["example"]
    blocked = [
        (f"{a}-{b}.example.{domains[i % len(domains)]}", allowed[(7 * i) % len(allowed)][1] if allowed else "/")
        for i, (a, b) in enumerate((a, b) for a in BLOCK_WORDS for b in BLOCK_WORDS if a != b)
    ]
    rows = [(*url, False) for url in allowed] + [(*url, True) for url in blocked if allowed]
    return parts.sparkSession.createDataFrame(rows, "host string, path string, blocked boolean")


def train(rows: list[tuple[list[int], bool]]) -> tuple[np.ndarray, float]:
    """Weights and bias by full-batch gradient descent; both classes weigh the same."""
    weights, bias = np.zeros(FEATURES), 0.0
    blocked = np.array([row[1] for row in rows], float)
    if not len(rows) or blocked.min() == blocked.max():
        return weights, -1.0 if not len(rows) or not blocked.min() else 1.0
    sizes = np.array([len(row[0]) for row in rows])
    owner = np.repeat(np.arange(len(rows)), sizes)
    index = np.concatenate([np.asarray(row[0], np.int64) for row in rows])
    scale = 1 / np.sqrt(sizes)
    share = np.where(blocked == 1, 0.5 / blocked.sum(), 0.5 / (1 - blocked).sum())
    for _ in range(STEPS):
        scores = np.bincount(owner, weights[index], len(rows)) * scale + bias
        error = (1 / (1 + np.exp(-scores)) - blocked) * share
        gradient = np.bincount(index, (error * scale)[owner], FEATURES)
        weights -= LEARNING_RATE * (gradient + DECAY * weights)
        bias -= LEARNING_RATE * error.sum()
    return weights, bias


def report(pages: DataFrame, rules: dict[str, str] = RULES) -> DataFrame:
    """Every page's host, path, rule and verdict, and the model's probability of blocking."""
    parts = with_parts(pages.select("page_id", "url")).drop("url").withColumn("rule", longest_rule(rules))
    verdicts = F.create_map(*[F.lit(part) for rule in rules.items() for part in rule])
    judged = parts.withColumn("by_rule", F.when(F.col("rule").isNotNull(), F.try_element_at(verdicts, F.col("rule"))))
    sample = labelled(parts).select(features().alias("grams"), "blocked")
    rows = [(row.grams, row.blocked) for row in sample.collect()]  # as many as the labelled table has
    model = pages.sparkSession.sparkContext.broadcast(train(rows))

    @F.pandas_udf("double")
    def blocks(grams: pd.Series) -> pd.Series:
        weights, bias = model.value
        scores = [weights[np.asarray(own, np.int64)].sum() / max(1, len(own)) ** 0.5 + bias for own in grams]
        return pd.Series(1 / (1 + np.exp(-np.array(scores, float))))

    scored = judged.withColumn("p_block", blocks(features()))
    by_model = F.when(F.col("p_block") > 0.5, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("by_rule", by_model).alias("verdict"), "p_block")
