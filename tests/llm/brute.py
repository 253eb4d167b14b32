"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import collections
import hashlib
import string

SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text):
    return (text or "").encode().split()


def roots(nodes, links):
    """The smallest node reachable from each."""
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingle_set(text):
    w = (text or "").translate(LOWER).encode().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def near_duplicates(rows):
    """{id: (set size, component)} from (id, text) rows with distinct ids."""
    sets = {i: shingle_set(t) for i, t in rows}
    having = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            having[x].append(i)
    common = collections.Counter()
    for ids in having.values():
        for k, a in enumerate(ids):
            for b in ids[k + 1:]:
                common[a, b] += 1
    links = [(a, b) for (a, b), n in common.items()
             if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n)]
    root = roots(sets, links)
    return {i: (len(s), root[i]) for i, s in sets.items()}


def repeats(rows, size=50):
    """{id: (words, removed, sha256 of kept)} from (id, text) rows with distinct ids."""
    first = {}
    for i, t in sorted(rows):
        w = words(t)
        for k in range(len(w) - size + 1):
            first.setdefault(tuple(w[k:k + size]), i)
    out = {}
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if first[tuple(w[k:k + size])] < i:
                gone[k:k + size] = [True] * size
        left = [x for x, g in zip(w, gone) if not g]
        out[i] = (len(w), sum(gone), hashlib.sha256(b" ".join(left)).hexdigest())
    return out
