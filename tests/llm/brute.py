"""Plain versions of the training-data operators, for comparison."""

import re
from collections import Counter

WORD = re.compile(r"[^ \t-\r]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width=4):
    w = WORD.findall((text or "").translate(LOWER))
    if len(w) < width:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1))


def components(docs, percent=85):
    """{id: least id reachable} by comparing all pairs."""
    sets = {i: shingles(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def repeat_words(text):
    w = WORD.findall(text or "")
    n = Counter(zip(w, w[1:], w[2:]))
    hit = {i + k for i, t in enumerate(zip(w, w[1:], w[2:])) if n[t] > 1 for k in range(3)}
    return len(w), len(hit)
