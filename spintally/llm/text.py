"""Words of texts, as Spark expressions and inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

# What separates words.
SPACES = r"[\x20\x09-\x0D]+"
NOT_SPACES = r"[^\x20\x09-\x0D]+"
NOT_LETTERS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# The same for bytes.translate: everything that ends a word becomes a space.
LETTERS_ONLY = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)

DIGITS = 16

STEP = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)


def spaced_words(text: Column) -> Column:
    """Runs of characters other than ASCII white space; none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def letter_words(text: Column) -> Column:
    """Runs of digits, letters and non-ASCII characters, with A-Z lower-cased; none for NULL."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())
    return F.array_remove(F.split(lowered, NOT_LETTERS), "")


def word_digits(words: Column) -> Column:
    """Sixteen hexadecimal digits of a hash of each word, as one string of bytes."""
    digits = lambda word: F.hex(F.xxhash64(word).bitwiseOR(F.lit(-(2**63))))
    return F.array_join(F.transform(words, digits), "").cast("binary")


def window_hashes(digits: Column, n: Column, width: int) -> Column:
    """A hash of each ``width`` consecutive words, from the digits of all ``n``."""
    window = lambda digits: F.transform(
        F.sequence(F.lit(1), DIGITS * (n - width) + 1, F.lit(DIGITS)),
        lambda at: F.xxhash64(F.substring(digits, at, DIGITS * width)),
    )
    # Passed on through an array of one, as a lambda's variable is not copied for each window.
    found = F.get(F.transform(F.array(digits), window), F.lit(0))
    return F.when(n >= width, found).otherwise(F.array().cast("array<bigint>"))


def spaced_tokens(text: str | None) -> list[bytes]:
    """As :func:`spaced_words`; bytes.split knows just the same six white-space characters."""
    return text.encode().split() if text else []


def letter_tokens(text: str | None) -> list[bytes]:
    """As :func:`letter_words`."""
    return text.encode().translate(LETTERS_ONLY).split() if text else []


def hashed(tokens: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))


def mixed(values: np.ndarray) -> np.ndarray:
    """A one-to-one mix of 64-bit numbers, for an order that looks random."""
    values = (values ^ (values >> np.uint64(31))) * MIX
    return values ^ (values >> np.uint64(29))


def rolling(words: np.ndarray, width: int, step: np.uint64 = STEP) -> np.ndarray:
    """A hash of each ``width`` consecutive words; none where there are fewer."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = words[:n].copy()
    for i in range(1, width):
        total *= step
        total += words[i : i + n]
    return mixed(total)


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes; of fewer words than ``width``, one of the whole."""
    return np.unique(rolling(words, max(1, min(width, len(words)))))


def signed(values: np.ndarray) -> np.ndarray:
    """The same bits as Spark's bigint."""
    return values.view(np.int64)
