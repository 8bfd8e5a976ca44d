import random

import numpy as np

from palmyra.llm import decontaminate

from .helpers import contaminated_words, words


def check(spark, docs, items):
    d = spark.createDataFrame([(*r, "i") for r in docs], "doc_id long, text string, item string")
    b = spark.createDataFrame(items, "item_id string, text string")
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, tuple(r["items"]), r.contaminated)
                 for r in decontaminate.contamination(d, b).collect())
    # Items without an id hit words, but are not listed.
    given = {(n, k): v for n, (k, v) in enumerate(items)}
    want = []
    for i, t in docs:
        hit, found = contaminated_words(t, given)
        found = {k for _, k in found if k is not None}
        want.append((str(i), len(words(t)), len(hit), tuple(sorted(found)), bool(hit)))
    assert got == sorted(want)


def test_winnowing_keeps_a_minimum_of_every_run():
    rng = np.random.default_rng(2)
    for n in range(0, 40):
        grams = rng.integers(0, 6, n).astype(np.uint64)
        at = set(decontaminate.winnow(grams, 6).tolist())
        for i in range(max(1, n - 5) if n else 0):
            run = grams[i:i + 6]
            assert any(i <= p < i + 6 and grams[p] == run.min() for p in at)


def test_against_brute_force(spark):
    rng = random.Random(5)
    vocab = ["a", "b", "c", "Dé", "e1", "f"]
    items = [(f"i{n}", " ".join(rng.choices(vocab, k=k))) for n, k in
             enumerate([1, 2, 3, 5, 6, 7, 9, 9, 10, 10, 11, 12, 20, 25, 40])]
    items += [("twin", items[-1][1]), ("none", None), ("empty", ""), (None, "a b c"), ("marks", "?!")]
    docs = [(n, " ".join(rng.choices(vocab, k=rng.randrange(0, 60)))) for n in range(80)]
    docs += [(100, items[14][1].upper()), (101, f"x {items[12][1]}, {items[12][1]} y"), (102, None),
             (103, ""), (100, "repeated id"), (None, items[13][1]), (104, "a " * 40_000)]
    check(spark, docs, items)


def test_rare_words(spark):
    rng = random.Random(6)
    text = [f"w{i}" for i in range(500)]
    items = [("long", " ".join(text[100:160])), ("ten", " ".join(text[300:310])),
             ("nine", " ".join(text[400:409]))]
    docs = []
    for n in range(60):
        a, k = rng.randrange(490), rng.randrange(5, 30)
        docs.append((n, " ".join(["pre"] + text[a:a + k] + ["post"])))
    check(spark, docs, items)


def test_only_items_without_an_id(spark):
    check(spark, [(1, "a b c d"), (2, "a c")], [(None, "b c"), (None, "b c"), (None, None)])
    docs = spark.createDataFrame([(1, "a b c d"), (2, "a c")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "b c")], "item_id string, text string")
    assert [r.doc_id for r in decontaminate.keep_clean(docs, items).collect()] == [2]


def test_empty_tables(spark):
    check(spark, [], [("i", "a b c")])
    check(spark, [(1, "a b c")], [])


def test_clean_rows_stay_with_their_columns(spark):
    d = spark.createDataFrame([(1, "x a b c y", "k"), (2, "a b", "l"), (2, "a b c", "m"), (None, "a b c", "n"),
                               (None, None, "o"), (3, "", "p")], "doc_id long, text string, doc string")
    b = spark.createDataFrame([(7, "A b C")], "item_id long, text string")
    kept = decontaminate.keep_clean(d, b)
    assert kept.columns == d.columns
    assert sorted(r.doc for r in kept.collect()) == ["l", "o", "p"]
