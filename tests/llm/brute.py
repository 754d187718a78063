"""Plain versions of the operators' rules, to hold small results against."""

import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text, width=4):
    w = words(text)
    return frozenset(zip(*(w[k:] for k in range(width)), strict=False)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def components(rows, num=85, den=100):
    """{id: (size, component)} by comparing all pairs of distinct sets."""
    ids = defaultdict(list)
    for i, text in rows:
        if i is not None:
            ids[shingles(text)].append(i)
    parent = {i: i for v in ids.values() for i in v}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def union(x, y):
        x, y = find(x), find(y)
        parent[max(x, y)] = min(x, y)

    sets = [s for s in ids if s]
    for k, s in enumerate(sets):
        for i in ids[s]:
            union(i, ids[s][0])
        for t in sets[:k]:
            shared = len(s & t)
            if den * shared >= num * (len(s) + len(t) - shared):
                union(ids[s][0], ids[t][0])
    return {i: (len(s), find(i)) for s, v in ids.items() for i in v}


def edit_distance_to_run(item, text):
    """Least word edits between ``item`` and any run of ``text``."""
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, v in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (w != v)))
        row = new
    return min(row)


def water_fill(budget, children):
    """{name: share} of {name: (weight, cap)}: by weight, shortages go to the others, whole tokens."""
    open_, share = {k: v for k, v in children.items() if v[0] > 0}, {}
    rest = min(budget, sum(c for _, c in open_.values()))
    while open_:
        total = sum(w for w, _ in open_.values())
        full = {k for k, (w, c) in open_.items() if c * total <= w * rest}
        if not full:
            upto = 0
            for k, (w, c) in sorted(open_.items(), key=lambda x: (x[1][1] / x[1][0], x[0])):
                share[k] = (upto + w) * rest // total - upto * rest // total
                upto += w
            return share
        for k in full:
            share[k] = open_[k][1]
            rest -= open_.pop(k)[1]
    return share


