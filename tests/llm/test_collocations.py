import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from palmyra.llm import collocations
from tests.llm.helpers import ascii_lower

SCHEMA = "doc_id long, text string, lang string, a long, h1 string, grp int, word string"
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def counts(rows):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", ascii_lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    return f, n


def by_hand(rows, least=10, top=2000):
    out, (f, n) = [], counts(rows)
    for lang, c in f.items():
        candidates = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        most = Counter()
        for p, a in candidates.items():
            if len(p) == 3:
                for q in (p[:2], p[1:]):
                    most[q] = max(most[q], a)
        found = []
        for p, a in candidates.items():
            if len(p) == 2 and p in most and 100 * most[p] >= 50 * a:
                continue
            score, k = min((1_000_000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def mined(spark, rows, **options):
    docs = spark.createDataFrame([(1, t, g, 5, "x", 3, "y") for t, g in rows], SCHEMA).repartition(4)
    got = collocations.mine(docs, **options)
    assert got.columns == COLUMNS
    return sorted(map(tuple, got.collect()))


def corpus(seed=0, n=120):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["É", "New", "york", "the", "x" * 400, "\x1f", "#$%"]
    weights = [1 / (i + 1) for i in range(len(words))]
    rows = []
    for i in range(n):
        w = rng.choices(words, weights, k=rng.randint(0, 80))
        text = "".join(x + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", "\r\n", ",", " "]) for x in w)
        rows.append((text + " new York the " * (i % 3), rng.choice(["en", "en", "de", None, "und", ""])))
    return rows + [(None, "en"), ("", None), ("a a a a a a a a a a a a a a", "en"), (" \t . ", "fr")] + rows[:20]


# Budgets that no word, some words, and some pairs exceed.
@pytest.mark.parametrize("budget", [10**6, 150, 12, 1])
def test_against_brute_force(spark, budget):
    rows = corpus()
    assert mined(spark, rows, least=4, budget=budget) == by_hand(rows, least=4)


def test_limit_and_ties(spark):
    rows = [(" . ".join(f"k{i} v{i}" for i in range(30)), "en")] * 12 + corpus(1, 30)
    assert mined(spark, rows, top=7) == by_hand(rows, top=7)
    assert mined(spark, rows) == by_hand(rows)


def test_words_hashed_anew_give_the_same(spark, monkeypatch):
    rows = corpus(2, 40)
    docs = spark.createDataFrame(rows, "text string, lang string")
    again = collocations.count_words(collocations._rows(docs, "lang", "text"), 1).collect()
    first = collocations.count_words(collocations._rows(docs, "lang", "text"), 0).collect()
    assert {(r.grp, r.word, r.n) for r in again} == {(r.grp, r.word, r.n) for r in first}
    assert {r.h for r in again}.isdisjoint(r.h for r in first if len(r.word) <= 256)


def test_empty_table(spark):
    assert mined(spark, []) == []


def test_long_text(spark):
    rng = random.Random(5)
    rows = [(" ".join(rng.choices(["a", "b", "c", "dd"], k=200_000)), "en")]
    assert mined(spark, rows, budget=5_000) == by_hand(rows)


def test_groups_stay_within_the_budget():
    weight = np.array([3, 4, 0, 9, 1, 1, 1, 0, 7])
    group = collocations.pack(weight, 7)
    sums = [int(weight[group == g].sum()) for g in range(group.max() + 1)]
    assert (np.diff(group) >= 0).all() and all(s <= 7 or s == 9 for s in sums)


def test_small_groups_share_tasks():
    full = collocations.BUDGET
    assert collocations.n_tasks(9, 6 * full, 8) == 18          # groups of the usual size: two tasks each
    assert collocations.n_tasks(1, 10, 8) == 2
    assert collocations.n_tasks(5000, 6000, 8) == 8            # each of them had two tasks, 10,000
    assert collocations.n_tasks(90_000, 6 * full, 8) == 26
