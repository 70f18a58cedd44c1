"""Plain versions of the operators' contracts, for small tables."""

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {a: a + 32 for a in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def statistics(text):
    text = text or ""
    w = words(text)
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def shingles(text):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def near_components(rows, percent=75):
    """doc_id -> (set size, component) by comparing all pairs."""
    sets = {d: shingles(t) for d, t in rows if d is not None}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d)) for d in ids}


def without_repeats(rows, window=13):
    """(doc_id, words, removed, digest of the kept words) of each row."""
    first = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - window + 1 if d is not None else 0):
            key = tuple(w[i : i + window])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1 if d is not None else 0):
            if first[tuple(w[i : i + window])] < d:
                gone[i : i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out
