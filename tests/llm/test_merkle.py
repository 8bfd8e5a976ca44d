import hashlib
import zlib

import pytest

from palmyra.llm import merkle


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def reduced(nodes):
    """All levels of a list of nodes."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i:i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def way(levels, i):
    out = []
    for level in levels[:-1]:
        lo = i // 8 * 8
        out.append((level[lo:i], level[i + 1:lo + 8]))
        i //= 8
    return out


def folded(node, path):
    for before, after in path:
        node = h("".join(before) + node + "".join(after))
    return node


def by_hand(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang),
                     key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = own, reduced([leaf(r) for r in own])
    top = reduced([trees[lang][1][-1][0] for lang in langs])
    out = []
    for j, lang in enumerate(langs):
        own, levels = trees[lang]
        for i, r in enumerate(own):
            path = way(levels, i) + way(top, j)
            held = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                held = (*r[:4], "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[4]))
            end = folded(leaf(held), path)
            out.append((r[0], leaf(r), levels[-1][0], top[-1][0],
                        h("".join("".join(b + a) for b, a in path)), end, end == top[-1][0]))
    return out


def key(r):
    return tuple((v is None, str(v)) for v in r)


def check(spark, rows, levels):
    docs = spark.createDataFrame([(*r, 7, "x") for r in rows],
                                 "doc_id long, source string, lang string, n_chars long, text string, "
                                 "pos long, digest string")
    got = merkle.audit(docs, levels=levels)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                           "verified"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(by_hand(rows), key=key)


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_against_brute_force(spark, levels):
    rows = [(i * 7 % 301, f"s{i % 3}", "en", i, f"Text {i} Été") for i in range(150)]
    rows += [(i, None, f"l{i % 11}", None, "UPPER" if i % 2 else "low") for i in range(200, 240)]
    rows += [(9, "s", "de", 1, "")] + [(3, "s", None, 4, None), (4, "s", None, 4, "A" * 50_000)]
    rows += [(None, "s", "en", 1, "no id")] * 3 + [(5, "s", "en", 1, "Same")] * 20
    rows += [(2**63 - 1, "s", "é", 1, "Z"), (-5, "s", "é", 1, "Z"), (6, "s", "", 1, "Z")]
    check(spark, rows, levels)


@pytest.mark.parametrize("n", [1, 8, 9, 64, 65])
def test_full_and_lone_runs(spark, n):
    check(spark, [(i, "s", "en", 1, f"T{i}") for i in range(n)], 1)


def test_whole_table_in_one_group_and_default_levels(spark, sf0001):
    docs = spark.read.parquet(f"{sf0001}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = merkle.audit(docs).collect()
    assert sorted(map(tuple, got), key=key) == sorted(by_hand(rows), key=key)
    changed = {r.doc_id for r in got if not r.verified}
    assert changed and changed == {r[0] for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 0
                                   and r[4] and any("A" <= c <= "Z" for c in r[4])}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, source string, lang string, n_chars long, text string")
    assert merkle.audit(docs).collect() == []


def test_null_and_empty_fields_differ():
    assert leaf((None, "")) != leaf(("", None))
    assert merkle.depth_of(1, 4) == 0 and merkle.depth_of(9, 4) == 2 and merkle.depth_of(10**6, 4) == 4
