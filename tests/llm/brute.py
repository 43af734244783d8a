"""Plain-Python versions of the contracts, for small tables."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def remove_repeats(docs, window=50):
    """docs: (doc_id, text) -> {doc_id: (n_words, n_removed, sha of the kept words)}; ids are unique."""
    first = {}
    cut = {d: words(t) for d, t in docs}
    for d, w in cut.items():
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            first[k] = min(first.get(k, d), d)
    out = {}
    for d, w in cut.items():
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < d:
                gone[i:i + window] = [True] * window
        kept = [x for x, g in zip(w, gone) if not g]
        out[d] = (len(w), sum(gone), sha(" ".join(kept)))
    return out


def shingles(text, k=5):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    w = words(low)
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def near_duplicates(docs):
    """docs: (doc_id, text) -> {doc_id: (n_shingles, component_id)}; candidates share a shingle, so all links are found."""
    sets = {d: shingles(t) for d, t in docs}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    where = {}
    for d in sorted(sets):
        near = {}
        for s in sets[d]:
            for o in where.setdefault(s, []):
                near[o] = near.get(o, 0) + 1
            where[s].append(d)
        for o, n in near.items():
            if 100 * n >= 75 * (len(sets[d]) + len(sets[o]) - n):
                a, b = sorted((find(o), find(d)))
                parent[b] = a
    return {d: (len(s), find(d)) for d, s in sets.items()}
