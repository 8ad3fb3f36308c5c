"""License scans: short phrases word by word, and notices with a few edits.

Texts are compared as their words, in small letters with one space between. A phrase
counts wherever its words stand one after the other. A notice of ``k`` allowed
edits is cut into ``k + 1`` pieces, of which an occurrence within ``k`` edits must
hold one unchanged; where a piece is found, the ``regex`` library matches the
notice around it with bounded errors, and tells the span and the number of edits. It searches the piece's own
stretch, which is too short for two notices, so a text costs a search of bounded length for each piece found, however often
notices repeat. Of matches that overlap, the one of fewest edits stays, then the first; what it leaves of the others'
stretches is searched again.

Cases: a NULL or empty text has no words, no labels and score 0. Overlapping
places of a phrase all count. A notice that holds another has the labels of both. Very long texts are scanned whole. Repeated rows are judged alike. Empty tables give
empty results. Other columns are left alone.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass, field

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spintally.llm.text import letter_tokens

# Phrases with their labels.
PHRASES = {
    b"cc by": "cc-by",
    b"general public license": "gpl",
    b"all rights reserved": "reserved",
}
# Short notices with their labels.
NOTICES = {
    "licensed under the apache license version 2 0": "apache",
    "permission is hereby granted free of charge": "mit",
    "permission to use copy modify and or distribute this software": "isc",
    "redistribution and use in source and binary forms": "bsd",
    "this software is provided as is without any express or implied warranty": "zlib",
    "boost software license version 1 0": "boost",
    "free and unencumbered software released into the public domain": "unlicense",
    "licensed under the gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "gnu free documentation license": "gfdl",
    "subject to the terms of the mozilla public license": "mpl",
    "eclipse public license": "epl",
    "european union public licence": "eupl",
    "common development and distribution license": "cddl",
    "academic free license": "afl",
    "artistic license 2 0": "artistic",
    "microsoft public license": "ms-pl",
    "python software foundation license": "psf",
    "sil open font license": "ofl",
    "open database license": "odbl",
    "creative commons attribution": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution noderivatives": "cc-by-nd",
    "creative commons zero public domain dedication": "cc0",
    "copyright all rights reserved": "reserved",
}
EDITS_PER_CHARACTER = 0.1


@dataclass(frozen=True)
class Notice:
    text: str
    label: str
    edits: int = field(init=False)
    pieces: tuple[tuple[int, bytes], ...] = field(init=False)
    pattern: object = field(init=False)

    def __post_init__(self):
        edits = max(1, int(len(self.text) * EDITS_PER_CHARACTER))
        cuts = [len(self.text) * i // (edits + 1) for i in range(edits + 2)]
        pieces = tuple((a, self.text[a:b].encode()) for a, b in zip(cuts, cuts[1:]))
        object.__setattr__(self, "edits", edits)
        object.__setattr__(self, "pieces", pieces)
        object.__setattr__(self, "pattern", regex.compile(rb"(?be)(?:%s){e<=%d}" % (regex.escape(self.text).encode(), edits)))

    def stretches(self, text: bytes) -> list[tuple[int, int]]:
        """Where the notice may lie, around each exact piece."""
        found = set()
        for offset, piece in self.pieces:
            at = text.find(piece)
            while at >= 0:
                start = at - offset
                found.add((max(0, start - self.edits), min(len(text), start + len(self.text) + self.edits)))
                at = text.find(piece, at + 1)
        return sorted(found)

    def matches(self, text: bytes) -> list[tuple[int, int, int]]:
        """Start, end and number of edits of matches that do not overlap; none fits between them."""
        taken: list[tuple[int, int, int]] = []
        left = self.stretches(text)
        while left:
            found = []
            for start, end in left:
                m = self.pattern.search(text, start, end) if end - start >= len(self.text) - self.edits else None
                if m:
                    found.append((sum(m.fuzzy_counts), m.start(), m.end(), (start, end)))
            rest = []
            for edits, start, end, stretch in sorted(found):
                at = bisect_left(taken, (start, end, edits))
                if at < len(taken) and taken[at] == (start, end, edits):
                    continue
                if (at and taken[at - 1][1] > start) or (at < len(taken) and taken[at][0] < end):
                    rest.append(stretch)
                else:
                    taken.insert(at, (start, end, edits))
            left = sorted({part for stretch in rest for part in _outside(taken, *stretch)} - set(left))
        return taken


def _outside(taken: list[tuple[int, int, int]], start: int, end: int) -> list[tuple[int, int]]:
    """What is left of a stretch between matches."""
    parts = []
    at = max(bisect_left(taken, (start,)) - 1, 0)
    while at < len(taken) and taken[at][0] < end:
        if taken[at][0] > start:
            parts.append((start, taken[at][0]))
        start = max(start, taken[at][1])
        at += 1
    return [*parts, (start, end)] if start < end else parts


def phrase_places(spaced: bytes, phrase: bytes) -> list[int]:
    """Numbers of the words that a phrase starts at; the text has a space before and after every word."""
    sought, found, at, words, counted = b" " + phrase + b" ", [], -1, 0, 0
    while (at := spaced.find(sought, at + 1)) >= 0:
        words += spaced.count(b" ", counted, at)
        counted = at
        found.append(words)
    return found


def scan_text(text: str | None, notices: list[Notice]) -> tuple:
    tokens = letter_tokens(text)
    spaced = b" " + b" ".join(tokens) + b" " if tokens else b""
    places = {label: phrase_places(spaced, phrase) for phrase, label in PHRASES.items()}
    starts = [at for found in places.values() for at in found]
    base = sorted({label for label, found in places.items() if found})
    spans, score = [], 1.0 if base else 0.0
    for notice in notices:
        words, counted = 0, 0
        for start, end, edits in notice.matches(spaced):
            words += spaced.count(b" ", counted, start + 1)
            counted = start + 1
            first = max(words - 1, 0)
            last = max(words + spaced.count(b" ", counted, end) - 1, first)
            spans.append((first, last, notice.label, edits))
            score = max(score, 1 - edits / len(notice.text))
    labels = sorted({*base, *(label for _, _, label, _ in spans)})
    return (
        len(tokens),
        len(starts),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(base),
        ",".join(labels),
        score,
        ",".join(f"{label}:{first}:{last}:{edits}" for first, last, label, edits in sorted(spans)),
    )


COLUMNS = {
    "n_words": "bigint",
    "n_base": "bigint",
    "first_word": "bigint",
    "last_word": "bigint",
    "base_labels": "string",
    "labels": "string",
    "score": "double",
    "notices": "string",
}


def report(docs: DataFrame, texts: dict[str, str] = NOTICES) -> DataFrame:
    """Every document's phrases and labels, and its notices as label, first word, last word and edits."""

    @F.pandas_udf(", ".join(f"{name} {kind}" for name, kind in COLUMNS.items()))
    def scan(column: pd.Series) -> pd.DataFrame:
        notices = [Notice(text, label) for text, label in texts.items()]
        rows = [scan_text(text, notices) for text in column]
        out = pd.DataFrame(rows, columns=list(COLUMNS))
        return out.astype({"first_word": "Int64", "last_word": "Int64"})

    return docs.select("doc_id", scan("text").alias("found")).select("doc_id", "found.*")
