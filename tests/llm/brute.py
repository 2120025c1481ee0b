"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np

SPACES = re.compile(r"[\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, lower=False):
    text = text or ""
    return [w for w in SPACES.split(text.translate(LOWER) if lower else text) if w]


def shingles(text, size=5):
    w = words(text, lower=True)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1)))


def similar(a, b):
    both = len(a & b)
    return bool(a and b) and 100 * both >= 80 * (len(a) + len(b) - both)


def components(rows):
    """{row index: smallest id reachable} of (id, text) rows."""
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if similar(sets[i], sets[j]):
                label[find(i)] = find(j)
    smallest = {}
    for i, (key, _) in enumerate(rows):
        smallest[find(i)] = min(smallest.get(find(i), key), key)
    return {i: smallest[find(i)] for i in range(len(rows))}


def base_quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {i + k for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for k in range(8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def mixed(rows):
    """Per source: (size, target) of (id, text, source) rows, by repeated resharing."""
    size = Counter()
    for _, text, source in rows:
        size[source] += len(words(text))
    order = sorted((s for s in size if s is not None)) + ([None] if None in size else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(size.values()))
    while open_:
        share = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if share * weight[s] > 3 * size[s]}
        for s in over or open_:
            target[s] = 3.0 * size[s] if over else share * weight[s]
            left -= target[s]
        open_ -= over or set(open_)
    return {s: (size[s], target[s]) for s in order}


def entropy(text):
    n = np.array(list(Counter(text).values())) / len(text)
    return float(-(n * np.log2(n)).sum())
