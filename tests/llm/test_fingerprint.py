import hashlib
import random

import numpy as np
import pyarrow as pa

from palmyra.llm import fingerprint as fp

from .helpers import jaccard, shingles


def sketch(text, k=fp.SKETCH_SIZE):
    return next(fp.sketches(pa.array([text], pa.string()), k))


def test_small_sets_are_exact():
    rng = random.Random(1)
    vocab = [f"w{i}" for i in range(12)]
    texts = [" ".join(rng.choices(vocab, k=rng.randint(1, 40))) for _ in range(60)]
    for a, b in zip(texts, texts[1:]):
        sa, sb = shingles(a), shingles(b)
        assert abs(fp.resemblance(sketch(a), sketch(b)) - jaccard(sa, sb)) < 1e-9
        assert fp.distinct_count(sketch(a)) == len(sa)
        assert abs(fp.containment(sketch(a), sketch(b)) - len(sa & sb) / len(sa)) < 1e-9


def test_estimates_of_long_texts():
    words = [f"w{i}" for i in range(6000)]
    a, b = " ".join(words[:4000]), " ".join(words[1000:5000])
    sa, sb = shingles(a), shingles(b)
    assert abs(fp.resemblance(sketch(a), sketch(b)) - jaccard(sa, sb)) < 0.15
    assert abs(fp.distinct_count(sketch(a)) / len(sa) - 1) < 0.3
    assert abs(fp.containment(sketch(a), sketch(b)) - len(sa & sb) / len(sa)) < 0.25


def test_sketches_of_parts_merge():
    words = [f"w{i}" for i in range(3000)]
    whole = np.concatenate([sketch(" ".join(words[:1600])), sketch(" ".join(words[1500:]))])
    merged = fp.merge(sketch(" ".join(words[:1600])), sketch(" ".join(words[1500:])))
    assert merged.tolist() == np.unique(whole)[:fp.SKETCH_SIZE].tolist()
    assert fp.decode(fp.encode(merged)).tolist() == merged.tolist()


def test_texts_without_words():
    assert sketch(None).tolist() == sketch("").tolist() != sketch("!!").tolist()
    assert fp.resemblance(sketch("!!"), sketch("!!")) == 1.0
    assert fp.resemblance(sketch("!!"), sketch("")) == 0.0


def test_edits_follow_the_order_of_ids(spark):
    rows = [(7, "alpha beta gamma delta epsilon zeta"), (2, "é😀ü"), (11, None), (3, ""),
            (30, "x" * 9), (4, "one two three four five six seven"), (90, "y " * 40_000),
            (91, "alpha beta gamma delta epsilon zeta")]
    docs = spark.createDataFrame([(i, t, "r") for i, t in rows], "doc_id long, text string, range string")
    for per_range in (1, 3, 4096):
        got = {r.doc_id: r for r in _compare(docs, per_range)}
        order = sorted(rows)
        assert len(got) == len(rows)
        for n, (i, t) in enumerate(order):
            t, following = t or "", order[(n + 1) % len(order)][1] or ""
            edited = t[:len(t) - len(t) // 2] + following[:len(t) // 2]
            r = got[i]
            assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
            assert r.fingerprint == fp.encode(sketch(t))
            assert r.edited_fingerprint == fp.encode(sketch(edited))
            assert r.near_edited == fp.resemblance(sketch(t), sketch(edited))
            assert r.near_next == fp.resemblance(sketch(t), sketch(following))
        assert got[7].fingerprint == got[91].fingerprint


def _compare(docs, per_range):
    original = fp.with_next
    fp.with_next = lambda *a: original(*a, rows_per_range=per_range)
    try:
        return fp.compare_edits(docs).collect()
    finally:
        fp.with_next = original


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "z"), (None, "n"), (2, "b")]
    schema = "doc_id long, text string"
    got = fp.compare_edits(spark.createDataFrame(rows, schema)).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "1", "1", "2", "None"]
    assert fp.compare_edits(spark.createDataFrame([], schema)).count() == 0
    one = fp.compare_edits(spark.createDataFrame([(5, "abcd")], schema)).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"abab").hexdigest()


def test_merged_by_key(spark):
    texts = {"a": [" ".join(f"w{i}" for i in range(j, j + 300)) for j in (0, 100, 900)],
             "b": ["one two three four five six"]}
    docs = spark.createDataFrame([(k, t) for k, ts in texts.items() for t in ts], "key string, text string")
    got = {r.key: r.fingerprint for r in fp.merge_fingerprints(
        fp.fingerprint(docs, "key"), "key").collect()}
    for k, ts in texts.items():
        want = np.unique(np.concatenate([sketch(t) for t in ts]))[:fp.SKETCH_SIZE]
        assert got[k] == fp.encode(want)
