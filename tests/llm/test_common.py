import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from palmyra.llm import common

from .helpers import shingles, words

TEXTS = st.lists(st.one_of(st.none(), st.text(max_size=60),
                           st.text(alphabet="aB é1.,\n$ß", max_size=80)), max_size=8)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_follow_the_pattern(texts):
    got = []
    for w in common.iter_words(pa.array(texts, pa.string())):
        got += [w.text(a, b) for a, b in zip(w.first[:-1], w.first[1:])]
    assert got == [words(t) for t in texts]


def test_equal_words_have_equal_hashes_wherever_they_stand():
    w = next(common.iter_words(pa.array(["one two one", "x ONE", "oneone two"])))
    one, two, again, x, upper, both, other = w.hashes.tolist()
    assert one == again == upper and two == other and len({one, two, x, both}) == 4


def test_long_text_is_split_whole():
    text = " ".join(f"w{i}" for i in range(400_000))        # beyond one run of rows
    parts = list(common.iter_words(pa.array(["a b", text, "c"])))
    assert sum(len(p.hashes) for p in parts) == 400_003


def test_shingle_sets_have_the_size_of_brute_force():
    texts = [None, "", "!!", "a", "a b c d", "a b c d e", "a b c d e a b c d e", "x " * 50]
    got = [len(s) for s in common.shingle_sets(pa.array(texts, pa.string()), 5)]
    assert got == [len(shingles(t)) for t in texts]
    for s in common.shingle_sets(pa.array(texts, pa.string()), 5):
        assert (np.diff(s.astype(object)) > 0).all()


def test_components_of_a_chain_a_star_and_a_loop(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] \
        + [(200, 201), (201, 202), (202, 200), (300, 300)]
    got = {r.node: r.label for r in common.connected_components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 100 for i in range(100, 140))
    assert got[200] == got[201] == got[202] == 200 and 300 not in got


def test_components_of_no_edges(spark):
    assert common.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bloom_filter_misses_nothing(spark):
    keys = [hash((i, "k")) for i in range(3000)]
    df = spark.createDataFrame([(k,) for k in keys], "h long")
    filled = np.frombuffer(common.bloom_of(df, 1 << 16), dtype=np.uint64)
    inside = np.array(keys, dtype=np.int64).view(np.uint64)
    others = np.array([hash((i, "o")) for i in range(3000)], dtype=np.int64).view(np.uint64)
    assert common.bloom_has(filled, inside).all()
    assert common.bloom_has(filled, others).mean() < 0.02
    empty = np.frombuffer(common.bloom_of(df.limit(0), 1 << 16), dtype=np.uint64)
    assert not common.bloom_has(empty, inside).any()
