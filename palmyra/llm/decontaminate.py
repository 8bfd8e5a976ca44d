"""Benchmark decontamination by winnowed k-gram fingerprints.

A window is ``window`` consecutive words of a benchmark item; an item of fewer
words, but not none, is one window. A document word inside any occurrence of a
window is hit.

Both sides keep, of every run of ``window - gram + 1`` word-gram hashes, the
smallest (the rightmost among equals). A span of ``window`` shared words has the
same run on both sides, so at least one of its fingerprints is kept on both:
every window is found. An item of fewer words is one gram of its own length, for
which every position of a document is kept (a run of one).

Document fingerprints meet the benchmark's in two steps: a Bloom filter of fixed
size drops nearly all at the scan, and a join by hash decides on the rest. A
fingerprint carries the words around it, as far as a window with it can reach,
and a joined pair is extended over equal words to both sides: the words
themselves decide, not their hashes.

Cases: null and empty texts have no words; repeated items each count under their
own id; rows of one document id are judged on their own; empty tables give no
hits; the windows of items without an id are hit like any other, but such items are
neither counted nor listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palmyra.llm.common import (Words, bloom_has, bloom_of, give_back, gram_hashes, iter_words,
                                mix64, row_keys)
from palmyra.sources.writers import cut_lineage

WINDOW = 10
GRAM = 5
#: Bits of the filter, whatever the benchmark's size (1 MB; a full filter lets
#: fingerprints through to the join, which stays exact).
BLOOM_BITS = 1 << 23
SALT = 0x2545F4914F6CDD1D


def winnow(grams: np.ndarray, run: int) -> np.ndarray:
    """Positions of the rightmost minimum of every ``run`` consecutive values; of
    all of them together where there are fewer."""
    n = len(grams)
    if n == 0:
        return np.empty(0, np.int64)
    if n <= run:
        return np.array([n - 1 - int(np.argmin(grams[::-1]))])
    best = np.arange(n - run + 1)
    low = grams[:n - run + 1].copy()
    for j in range(1, run):
        here = grams[j:j + n - run + 1]
        take = here <= low
        low = np.where(take, here, low)
        best = np.where(take, np.arange(j, j + n - run + 1), best)
    return np.unique(best)


def _sized(hashes: np.ndarray, k: int) -> np.ndarray:
    """Grams of different lengths never share a hash by construction of the key."""
    return mix64(hashes + np.uint64(k * SALT % (1 << 64)))


def fingerprints(w: Words, a: int, b: int, window: int, gram: int, short: list[int]
                 ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(gram length, positions, hashes) of the words a .. b-1: winnowed ones of
    length ``gram``, and all of each length in ``short``."""
    if b - a >= window:
        grams = gram_hashes(w.hashes[a:b], gram)
        at = winnow(grams, window - gram + 1)
        yield gram, at, _sized(grams[at], gram)
    for k in short:
        if b - a >= k:
            grams = gram_hashes(w.hashes[a:b], k)
            yield -k, np.arange(len(grams)), _sized(grams, 1000 + k)


def _around(w: Words, a: int, b: int, k: int, at: int, window: int) -> tuple[str, str]:
    """Words before the gram, nearest first, and from the gram on, as far as a
    window with the gram reaches (for a short item: just the gram)."""
    reach = window - k if k > 0 else 0
    k = abs(k)
    left = w.text(max(a, a + at - reach), a + at)[::-1]
    return " ".join(left), " ".join(w.text(a + at, min(b, a + at + k + reach)))


FINGERPRINT = "h long, k int, left string, right string"


def item_fingerprints(items: DataFrame, id_col: str, text_col: str, window: int, gram: int
                      ) -> DataFrame:
    """(item, h, k, left, right) of every item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            names = batch.column("item").to_pylist()
            for w in iter_words(batch.column("text")):
                for name, a, b in zip(names[w.lo:w.hi], w.first[:-1], w.first[1:]):
                    short = [int(b - a)] if 0 < b - a < window else []
                    for k, at, hashes in fingerprints(w, a, b, window, gram, short):
                        out += [(name, h, k, *_around(w, a, b, k, p, window))
                                for p, h in zip(at.tolist(), hashes.astype(np.int64).tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, _ITEM_TYPES)],
                names=["item", "h", "k", "left", "right"])

    return (items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))
            .mapInArrow(run, f"item string, {FINGERPRINT}"))


_ITEM_TYPES = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string()]


def scan_documents(docs: DataFrame, id_col: str, text_col: str, bloom: bytes, short: list[int],
                   window: int, gram: int) -> DataFrame:
    """(row, id, text_key, n_words, prints) of every document; prints are those
    fingerprints that the filter lets through, with position and words around."""
    shared = docs.sparkSession.sparkContext.broadcast(bloom)
    element = pa.struct([("h", pa.int64()), ("k", pa.int32()), ("at", pa.int64()),
                         ("left", pa.string()), ("right", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = np.frombuffer(shared.value, dtype=np.uint64)
        keys = row_keys()
        for batch in batches:
            n_words, prints = [], []
            for w in iter_words(batch.column("text")):
                for a, b in zip(w.first[:-1], w.first[1:]):
                    n_words.append(int(b - a))
                    hits = []
                    for k, at, hashes in fingerprints(w, a, b, window, gram, short):
                        keep = bloom_has(filled, hashes)
                        for p, h in zip(at[keep].tolist(), hashes[keep].astype(np.int64).tolist()):
                            left, right = _around(w, a, b, k, p, window)
                            hits.append({"h": h, "k": k, "at": p, "left": left, "right": right})
                    prints.append(hits)
            yield pa.RecordBatch.from_arrays(
                [pa.array([next(keys) for _ in n_words], pa.int64()), batch.column("id"),
                 batch.column("text_key"), pa.array(n_words, pa.int64()), pa.array(prints, pa.list_(element))],
                names=["row", "id", "text_key", "n_words", "prints"])
        give_back()

    return (docs.select(F.col(id_col).cast("long").alias("id"),
                        F.xxhash64(F.col(text_col)).alias("text_key"), F.col(text_col).alias("text"))
            .mapInArrow(run, "row long, id long, text_key long, n_words long, prints array<struct<h:long, k:int, "
                             "at:long, left:string, right:string>>"))


def _same(a: list[str], b: list[str]) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def extend(pairs: DataFrame, window: int) -> DataFrame:
    """(row, item, lo, hi): the hit words of each joined pair of fingerprints."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.itertuples():
                right = _same(r.right.split(" "), r.item_right.split(" "))
                if r.k < 0:
                    if right == -r.k == len(r.item_right.split(" ")):
                        out.append((r.row, r.item, r.at, r.at + right))
                    continue
                left = _same(r.left.split(" "), r.item_left.split(" ")) if r.left and r.item_left else 0
                if right >= r.k and left + right >= window:
                    out.append((r.row, r.item, r.at - left, r.at + right))
            yield pd.DataFrame(out, columns=["row", "item", "lo", "hi"])

    return pairs.mapInPandas(run, "row long, item string, lo long, hi long")


def hit_spans(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str,
              item_text: str, window: int, gram: int) -> tuple[DataFrame, DataFrame]:
    """(scanned, spans): every document's row, and (row, item, lo, hi) of its hits."""
    prints = cut_lineage(item_fingerprints(items, item_col, item_text, window, gram),
                         "winnow-items")
    short = sorted(-r.k for r in prints.where("k < 0").select("k").distinct().collect())
    scanned = cut_lineage(scan_documents(docs, id_col, text_col, bloom_of(prints.select("h"), BLOOM_BITS), short,
                                         window, gram), "winnow-docs")
    pairs = (scanned.select("row", F.explode("prints").alias("p")).select("row", "p.*")
             .join(prints.select("h", "k", "item", F.col("left").alias("item_left"),
                                 F.col("right").alias("item_right")), ["h", "k"]))
    return scanned, cut_lineage(extend(pairs, window).distinct(), "winnow-spans")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                  window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per document row: id, n_words, n_hit, n_items, items (ids as strings,
    sorted) and contaminated (n_hit > 0)."""
    scanned, spans = hit_spans(docs, items, id_col, text_col, item_col, item_text, window, gram)
    hit = (spans.select("row", F.explode(F.sequence("lo", F.col("hi") - 1)).alias("at"))
           .distinct().groupBy("row").agg(F.count("*").alias("n_hit")))
    found = (spans.where("item IS NOT NULL").select("row", "item").distinct().groupBy("row")
             .agg(F.array_sort(F.collect_list("item")).alias("items")))
    none = F.array().cast("array<string>")
    return (scanned.select("row", "id", "n_words").join(hit, "row", "left")
            .join(found, "row", "left")
            .select(F.col("id").alias(id_col), "n_words",
                    F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
                    F.coalesce("items", none).alias("items"),
                    F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated")))


def keep_clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text: str = "text", window: int = WINDOW,
               gram: int = GRAM) -> DataFrame:
    """The rows of ``docs`` without a hit, with all their columns. The hit ones are
    written first, so the planner knows their size when it joins them."""
    scanned, spans = hit_spans(docs, items, id_col, text_col, item_col, item_text, window, gram)
    hit = cut_lineage(scanned.join(spans.select("row").distinct(), "row", "left_semi")
                      .select(F.coalesce("id", F.lit(0)).alias("id"), F.col("id").isNull().alias("no_id"),
                              "text_key").distinct(), "winnow-hit")
    key = F.col(id_col).cast("long")
    whole = docs.select(F.coalesce(key, F.lit(0)).alias("id"), key.isNull().alias("no_id"),
                        F.xxhash64(F.col(text_col)).alias("text_key"), F.struct("*").alias("doc"))
    return whole.join(hit, ["id", "no_id", "text_key"], "left_anti").select("doc.*")
