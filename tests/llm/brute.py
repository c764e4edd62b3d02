"""Plain single-machine versions of the corpus contracts."""

import collections
import hashlib
import math
import re

import numpy as np

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def substring(docs, width=35):
    """(id, n_words, n_removed, kept_sha256) per (id, text)."""
    tokens = [WORDS.findall(t or "") for _, t in docs]
    seen = collections.Counter(tuple(t[i:i + width]) for t in tokens for i in range(len(t) - width + 1))
    out = []
    for (d, _), t in zip(docs, tokens):
        gone = set()
        for i in range(len(t) - width + 1):
            if seen[tuple(t[i:i + width])] > 1:
                gone.update(range(i, i + width))
        kept = [w for i, w in enumerate(t) if i not in gone]
        out.append((d, len(t), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def shingles(text, size):
    w = WORDS.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)])


def components(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def near_duplicates(docs, size, percent=80):
    """(id, set size, component, kept) per (id, text) with distinct ids."""
    sets = {d: shingles(t, size) for d, t in docs}
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    comp = components(ids, links)
    return [(d, len(sets[d]), comp[d], comp[d] == d) for d in ids]


def cosine_links(vectors, least=0.95):
    """{id: (links, component, kept)} for {id: vector or None}."""
    good = {i: np.array(v, float) for i, v in vectors.items()
            if v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    links = [(a, b) for a in good for b in good if a < b and good[a] @ good[b] / np.sqrt((good[a] @ good[a]) * (good[b] @ good[b])) >= least]
    comp = components(vectors, links)
    n = collections.Counter(x for l in links for x in l)
    return {i: (n[i], comp[i], comp[i] == i) for i in vectors}
