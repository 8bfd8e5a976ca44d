import math
import struct
import zlib
from collections import defaultdict

import pytest
import xxhash

from palmyra.llm import sharding

WEIGHTS = [1.0, 2.0, 0.5, 1.0, 3.0]


def score(key, shard, weight, seed=0):
    h = xxhash.xxh64(struct.pack("<q", key), seed=42).intdigest()
    for x in (seed, shard):
        h = xxhash.xxh64(struct.pack("<i", x), seed=h).intdigest()
    return -math.log(((h >> 11) + 0.5) * 2.0 ** -53) / weight


def pick(key, weights):
    return min(range(len(weights)), key=lambda s: score(key, s, weights[s]))


def test_against_brute_force(spark):
    rows = [(i * 7 - 500, "é" * (i % 5)) for i in range(3000)] + [(3, None), (3, "same id"), (3, "same id")]
    docs = spark.createDataFrame([(*r, 4) for r in rows], "doc_id long, text string, shard int")
    got = sharding.assign(docs, WEIGHTS).collect()
    assert len(got) == len(rows)
    slots, taken = defaultdict(list), defaultdict(int)
    for r in got:
        assert r.shard == pick(r.doc_id, WEIGHTS)
        assert r.grown_shard == pick(r.doc_id, [*WEIGHTS, 1.0]) and r.grown_shard in (r.shard, 5)
        slots[r.shard].append(r.slot)
        taken[r.shard] += 1
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    for s, w in enumerate(WEIGHTS):
        assert abs(taken[s] / len(rows) - w / sum(WEIGHTS)) < 0.03
    sizes = sorted((r.doc_id, r.size, r.text_crc32) for r in got)
    assert sizes == sorted((i, 8 + len((t or "").encode()), zlib.crc32((t or "").encode()))
                           for i, t in rows)


def test_null_keys_lie_in_one_shard(spark):
    docs = spark.createDataFrame([(None, "a"), (None, "b"), (1, "c")], "doc_id long, text string")
    got = sharding.assign(docs, [1.0] * 8).collect()
    assert len({r.shard for r in got if r.doc_id is None}) == 1 and len(got) == 3


def test_empty_table_and_bad_weights(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.assign(docs, WEIGHTS).count() == 0
    with pytest.raises(ValueError):
        sharding.assign(docs, [1.0, 0.0])


def test_no_python_in_the_plan(spark, sf0001):
    from palmyra.llm.queries import QUERIES
    plan = QUERIES["op9_rendezvous_shards"](spark, sf0001)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
