"""Scanning texts for secrets: fixed patterns, and character Markov models.

Fixed patterns find assignments to names as ``password``, access keys and long
hexadecimal numbers. The models are trained from labelled samples: random strings and ordinary ones, a table that
the caller may give. The default one is made by rule from seeded random letters and from words joined to names, paths, dates and
lines. To the ordinary samples come all words of all documents that look like identifiers.
A first-order character model is trained from the transition counts of each, which
are summed over all documents and bounded by the square of the alphabet. A run of ``SHORTEST`` or more
key characters outside the fixed patterns' spans is reported as ``model`` where the
log-likelihood ratio of the two models, a character, is over a threshold: that of the best F1 on a
fifth of the samples, which is held out by a hash; :func:`fit` tells its precision and recall there. Paths are judged part by part.

Cases: a NULL or empty text has no spans. Spans count code points, the end
exclusive. Without any labelled secret the models are alike and report nothing. Very long texts are scanned whole.
Repeated rows are judged alike. Empty tables give empty results. Other columns
are left alone.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The patterns that find secrets, their least lengths, and their order.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE = 6
KINDS = ("assign", "access", "hex", "model")
# A text without any of these, in small letters, has no assignment.
HINTS = ("passw", "secret", "token", "api")

SHORTEST = 12
RUN = re.compile(r"[A-Za-z0-9+_=-]{%d,}" % SHORTEST)
# Of letters, and no digits among them: a longer mix may be a secret that nothing labels.
IDENTIFIER = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z_]{6,24}(?![A-Za-z0-9+/_=-])")

# Words that ordinary samples are joined of.
WORDS = (
    "account", "alpha", "application", "archive", "available", "background", "balance", "binary", "branch", "builder", "button",
    "cache", "category", "channel", "client", "column", "command", "config", "content", "counter", "customer", "database", "default",
    "device", "directory", "document", "element", "engine", "event", "example", "feature", "field", "filter", "folder", "format", "frame",
    "group", "handler", "header", "history", "image", "index", "input", "item", "label", "language", "layer", "library", "limit", "line",
    "list", "local", "message", "method", "model", "module", "name", "network", "number", "object", "option", "order", "output", "package",
    "page", "parameter", "parser", "path", "pattern", "player", "process", "profile", "project", "query", "random", "record", "report",
    "request", "result", "route", "sample", "schema", "script", "section", "server", "service", "session", "setting", "source", "state",
    "status", "stream", "string", "system", "table", "target", "template", "test", "text", "thread", "time", "user", "value", "version",
    "view", "window", "worker",
)
SAMPLES = 4000

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
SIZE = len(ALPHABET) + 2  # also a string's border, and any other character
CODES = np.full(256, SIZE - 1, np.int64)
CODES[[ord(c) for c in ALPHABET]] = np.arange(1, SIZE - 1)
CODES[0] = 0

Span = tuple[int, int, int, str]  # start, kind, end, value


def base_spans(text: str) -> list[Span]:
    spans: list[Span] = []
    lowered = text.lower()
    if any(hint in lowered for hint in HINTS):
        spans += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(spans)


def outside(spans: list[Span], start: int, end: int) -> bool:
    return all(end <= at or start >= stop for at, _, stop, _ in spans)


def transitions(strings: list[str]) -> np.ndarray:
    """Counts of character pairs, with a border at both ends of each string."""
    joined = "\0".join(["", *strings, ""]).encode("latin-1", "replace")
    codes = CODES[np.frombuffer(joined, np.uint8)]
    return np.bincount(codes[:-1] * SIZE + codes[1:], minlength=SIZE * SIZE)


def labelled(spark: SparkSession, seed: int = 1) -> DataFrame:
    """The default samples: ``string`` and whether it is ``secret``."""
    rng = random.Random(seed)
    digits, lower, upper = "0123456789", ALPHABET[26:52], ALPHABET[:26]
    kinds = (lower + upper + digits, upper + digits, lower + digits, "abcdef" + digits, lower + upper + digits + "+_-")
    rows = [("".join(rng.choices(rng.choice(kinds), k=rng.randint(12, 48))), True) for _ in range(SAMPLES)]
    for _ in range(SAMPLES):
        words = rng.choices(WORDS, k=rng.randint(2, 5))
        day = f"{rng.randint(1990, 2035)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}"
        rows.append(
            (
                rng.choice(
                    [
                        "_".join(words),
                        "-".join(words),
                        words[0] + "".join(map(str.title, words[1:])),
                        "".join(map(str.title, words)),
                        "_".join(words).upper(),
                        "".join(words),
                        f"{'-'.join(words)}-{rng.randint(0, 9999)}",
                        f"{words[0]}-{day}",
                        f"{day}-{rng.randint(0, 23):02}-{rng.randint(0, 59):02}-{rng.randint(0, 59):02}",
                        rng.choice("=-_+") * rng.randint(12, 60),
                        rng.choice(digits + lower + upper) * rng.randint(12, 40),
                        rng.choice(words[0]) + rng.choice([words[1][:2], "xy", "01"]) * rng.randint(6, 16),
                        "".join(digits[i % 10] for i in range(rng.randint(0, 9), rng.randint(21, 30))),
                        str(10 ** rng.randint(11, 18)),
                    ]
                ),
                False,
            )
        )
    return spark.createDataFrame(rows, "string string, secret boolean")


def ordinary_counts(docs: DataFrame) -> DataFrame:
    """``pair`` and ``times`` of the transitions in all documents' words that look like identifiers."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(SIZE * SIZE, np.int64)
        for batch in batches:
            total += transitions([word for text in batch["text"] if text for word in IDENTIFIER.findall(text)])
        pairs = np.flatnonzero(total)
        yield pd.DataFrame({"pair": pairs, "times": total[pairs]})

    found = docs.select("text").mapInPandas(count, "pair int, times bigint")
    return found.groupBy("pair").agg(F.sum("times").alias("times"))


@dataclass(frozen=True)
class Model:
    """Log ratio of each transition's probability among secrets and among ordinary strings, and a threshold."""

    table: np.ndarray
    threshold: float
    precision: float
    recall: float


def fit(labels: DataFrame, ordinary: pd.DataFrame) -> Model:
    """A model from a labelled table small enough for the driver, and counts of ordinary transitions.

    The documents' words weigh as much as the labelled ordinary strings together.
    """
    rows = [(row.string, row.secret, row.out) for row in labels.withColumn("out", F.pmod(F.xxhash64("string"), F.lit(5)) == 0).collect() if row.string]
    if not any(secret for _, secret, _ in rows):
        return Model(np.zeros(SIZE * SIZE), float("inf"), float("nan"), float("nan"))
    own = [transitions([s for s, secret, out in rows if secret == kind and not out]) for kind in (False, True)]
    seen = np.zeros(SIZE * SIZE)
    seen[ordinary["pair"]] += ordinary["times"]
    if seen.sum():
        own[0] = own[0] + seen * max(1.0, own[0].sum()) / seen.sum()
    counts = [(one + 0.5).reshape(SIZE, SIZE) for one in own]
    logs = [np.log(one / one.sum(axis=1, keepdims=True)) for one in counts]
    table = (logs[1] - logs[0]).ravel()
    tested = sorted(((log_ratio(s, table), secret) for s, secret, out in rows if out), reverse=True)
    positives = sum(secret for _, secret in tested)
    best, caught = (-1.0, 0.0, float("nan"), float("nan")), 0
    for i, (score, secret) in enumerate(tested):
        caught += secret
        following = tested[i + 1][0] if i + 1 < len(tested) else score - 1
        if caught and following < score:
            precision, recall = caught / (i + 1), caught / positives
            best = max(best, (2 * precision * recall / (precision + recall), (score + following) / 2, precision, recall))
    return Model(table, *best[1:])


def log_ratio(string: str, table: np.ndarray) -> float:
    """Per transition, for one string."""
    codes = CODES[np.frombuffer(f"\0{string}\0".encode("latin-1", "replace"), np.uint8)]
    return float(table[codes[:-1] * SIZE + codes[1:]].mean())


def model_spans(text: str, spans: list[Span], model: Model) -> list[Span]:
    found = []
    for m in RUN.finditer(text):
        if outside(spans, m.start(), m.end()) and log_ratio(m[0], model.table) > model.threshold:
            found.append((m.start(), 3, m.end(), m[0]))
    return found


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end, _ in spans)


def report(docs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Counts of the fixed patterns' spans, their digest, and all spans.

    ``labels`` is a small table of ``string`` and ``secret`` instead of the default one.
    """
    spark = docs.sparkSession
    ordinary = ordinary_counts(docs).toPandas()  # a row a pair of characters at most
    shared = spark.sparkContext.broadcast(fit(labelled(spark) if labels is None else labels, ordinary))

    @F.pandas_udf("n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")
    def scan(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            text = text or ""
            base = base_spans(text)
            kinds = [kind for _, kind, _, _ in base]
            digest = hashlib.sha256(written(base).encode()).hexdigest()
            every = sorted(base + model_spans(text, base, shared.value))
            rows.append((*map(kinds.count, range(3)), digest, written(every)))
        return pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.select("doc_id", scan("text").alias("found")).select("doc_id", "found.*")
