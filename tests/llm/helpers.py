"""Brute-force versions that the operators are held against."""

import re
from collections import defaultdict

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(ascii_lower(text))


def shingles(text, k=5):
    w = words(text)
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 0.0


def clusters(sets, threshold=0.8):
    """(smallest member, links) of each set under single linkage."""
    inverted = defaultdict(set)
    for i, s in enumerate(sets):
        for g in s:
            inverted[g].add(i)
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(sets)
    for i, s in enumerate(sets):
        for j in set().union(*(inverted[g] for g in s)) - {i} if s else ():
            if jaccard(s, sets[j]) >= threshold:
                links[i] += 1
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [(find(i), n) for i, n in enumerate(links)]


def contaminated_words(text, items, window=10):
    """(hit word positions, item ids) of a text; items: {id: text}."""
    w, hit, found = words(text), set(), set()
    for item, other in items.items():
        o = words(other)
        n = min(len(o), window)
        if not n:
            continue
        grams = {tuple(o[i:i + n]) for i in range(len(o) - n + 1)}
        for i in range(len(w) - n + 1):
            if tuple(w[i:i + n]) in grams:
                hit.update(range(i, i + n))
                found.add(item)
    return hit, found
