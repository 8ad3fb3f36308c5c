"""Every contract once more, the slow and plain way, over collected rows."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

SMALL_LETTERS = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def spaced(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def lettered(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().translate(SMALL_LETTERS))


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def base_counts(text):
    words, text = [w.decode() for w in spaced(text)], text or ""
    lines = [line for line in text.split("\n") if spaced(line)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times, covered = Counter(windows), set()
    for i, window in enumerate(windows):
        if times[window] > 1:
            covered.update(range(i, i + 5))
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def contamination(docs, items):
    windows, sizes = defaultdict(set), set()
    for item, text in items:
        words = lettered(text)
        for i in range(max(1, len(words) - 9) if words else 0):
            window = tuple(words[i : i + 10])
            windows[window].add(str(item))
            sizes.add(len(window))
    found = []
    for doc_id, text in docs:
        words, hit, seen = lettered(text), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                window = tuple(words[i : i + size])
                if window in windows:
                    hit.update(range(i, i + size))
                    seen |= windows[window]
        found.append((doc_id, len(words), len(hit), len(seen), sha(",".join(sorted(seen))), bool(hit)))
    return found


def repeats(docs):
    """Documents as (id, text) in the order of the contract."""
    earlier, found = set(), []
    for doc_id, text in docs:
        words, out = spaced(text), set()
        for i in range(len(words) - 19):
            window = tuple(words[i : i + 20])
            if window in earlier:
                out.update(range(i, i + 20))
            earlier.add(window)
        rest = b" ".join(w for i, w in enumerate(words) if i not in out)
        found.append((doc_id, len(words), len(out), sha(rest)))
    return found


def shingle_set(text, width):
    words = spaced((text or "").encode().translate(SMALL_LETTERS).decode())
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def linked(a, b, percent):
    both = len(a & b)
    return bool(a) and bool(b) and 100 * both >= percent * (len(a) + len(b) - both)


def components(docs, width, percent):
    """Per row its set's size and the least id that it is linked with."""
    sets = [shingle_set(text, width) for _, text in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if linked(sets[i], sets[j], percent):
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i in range(len(docs)):
        groups[root(i)].append(docs[i][0])
    least = {r: min((d for d in ids if d is not None), default=None) for r, ids in groups.items()}
    return [(docs[i][0], len(sets[i]), least[root(i)]) for i in range(len(docs))]


ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def secret_spans(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, text, re.I | re.A) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def phrases(text):
    words = lettered(text)
    places = [
        (i, label)
        for phrase, label in PHRASES.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.encode().split()
    ]
    starts = [i for i, _ in places]
    labels = ",".join(sorted({label for _, label in places}))
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), labels
