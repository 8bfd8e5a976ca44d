"""Document fingerprints: bottom-k sketches of shingle hashes.

The sketch of a text is the ``k`` smallest hashes of its distinct five-word
shingles, ascending. The sketch of a union is the ``k`` smallest of the sketches'
union, so sketches of parts merge. Two sketches estimate resemblance (Jaccard
similarity), containment and the count of distinct shingles; with fewer than
``k`` shingles all three are exact.

Cases: a text of one to four words has one shingle, of all its words; a text
without words, an empty or a null text has one, of its bytes. Equal texts so
always have equal sketches, and no sketch is empty.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palmyra.llm.common import shingle_sets

SHINGLE_WORDS = 5
SKETCH_SIZE = 128
SPACE = float(1 << 64)
#: Ranges of the table in id order, whatever its size; a larger table has larger ones.
MOST_RANGES = 20_000


def sketches(texts: pa.Array, k: int = SKETCH_SIZE, words: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """The sketch of each text, as ascending unsigned 64-bit values."""
    for text, hashes in zip(texts, shingle_sets(texts, words)):
        if len(hashes):
            yield hashes[:k]
        else:
            raw = (text.as_py() or "").encode()
            yield np.array([xxhash.xxh3_64_intdigest(raw, seed=1)], dtype=np.uint64)


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """A task holds the texts, sketches and results of so many rows at a time."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def encode(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.astype("<u8").tobytes()).decode()


def decode(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), dtype="<u8")


def merge(a: np.ndarray, b: np.ndarray, k: int = SKETCH_SIZE) -> np.ndarray:
    return np.union1d(a, b)[:k]


def distinct_count(a: np.ndarray, k: int = SKETCH_SIZE) -> float:
    return float(len(a)) if len(a) < k else (k - 1) / ((float(a[k - 1]) + 1) / SPACE)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = SKETCH_SIZE) -> float:
    """Share of the union's sketch that lies in both sketches."""
    union = merge(a, b, k)
    common = np.intersect1d(a, b, assume_unique=True)
    return float(np.isin(union, common, assume_unique=True).sum()) / len(union) if len(union) else 1.0


def containment(a: np.ndarray, b: np.ndarray, k: int = SKETCH_SIZE) -> float:
    """Estimated share of a's shingles that b has: from the resemblance and the
    union's count, |a & b| = J |a | b|."""
    size = distinct_count(a, k)
    if not size:
        return 1.0
    shared = resemblance(a, b, k) * distinct_count(merge(a, b, k), k)
    return min(1.0, shared / size)


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                k: int = SKETCH_SIZE, words: int = SHINGLE_WORDS) -> DataFrame:
    """(id, fingerprint, distinct_shingles) of every row, without a shuffle."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            found = list(sketches(batch.column(1), k, words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(encode, found), pa.string()),
                 pa.array([distinct_count(s, k) for s in found], pa.float64())],
                names=["id", "fingerprint", "distinct_shingles"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return (rows.mapInArrow(run, f"id {kind}, fingerprint string, distinct_shingles double")
            .withColumnRenamed("id", id_col))


def merge_fingerprints(parts: DataFrame, key: str, k: int = SKETCH_SIZE) -> DataFrame:
    """One fingerprint per ``key`` from those of its parts.

    A hot key is spread: each task first keeps its own ``k`` smallest distinct
    values per key (``row_number`` with a limit is evaluated before the shuffle).
    """
    def values(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            each = [decode(f).astype(np.int64) for f in b["fingerprint"]]
            yield pd.DataFrame({"key": np.repeat(b["key"].to_numpy(dtype=object),
                                                 [len(e) for e in each]),
                                "v": np.concatenate(each) if each else np.empty(0, np.int64)})

    kind = parts.schema[key].dataType.simpleString()
    rows = (parts.where(F.col("fingerprint").isNotNull())
            .select(F.col(key).alias("key"), "fingerprint")
            .mapInPandas(values, f"key {kind}, v long").distinct())
    # Unsigned order: flip the sign bit.
    order = F.col("v").bitwiseXOR(F.lit(-(1 << 63)))
    least = (rows.withColumn("r", F.row_number().over(Window.partitionBy("key").orderBy(order)))
             .where(F.col("r") <= k)
             .groupBy("key").agg(F.array_sort(F.collect_list(F.struct("r", "v"))).alias("l")))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"key": b["key"], "fingerprint":
                                [encode(np.array(list(v), dtype=np.int64).view(np.uint64))
                                 for v in b["vs"]]})

    return (least.select("key", F.col("l.v").alias("vs"))
            .mapInPandas(pack, f"key {kind}, fingerprint string").withColumnRenamed("key", key))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              rows_per_range: int = 4096, most_ranges: int = MOST_RANGES) -> DataFrame:
    """Rows in ranges of ascending id: (range, tail, id, text), where ``tail`` is 1
    for a copy of the row that follows the range (the first row of the next
    one; after the last range the very first row).

    Range limits are quantiles of the ids, one for about ``rows_per_range``
    rows and at most ``most_ranges``, so what is gathered and sent to the tasks is
    a row a range. Rows of one id lie in one range.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = rows.select("id").count()
    parts = min(most_ranges, max(1, n // rows_per_range))
    cuts = sorted(set(rows.select("id").approxQuantile(
        "id", [i / parts for i in range(1, parts)], 0.1 / parts))) if parts > 1 else []
    ranged = rows.withColumn("range", _range_of(F.col("id"), [int(c) for c in cuts]))
    # The first row of each range, by id and then text, as (id, text hash).
    firsts = (ranged.groupBy("range")
              .agg(F.min(F.struct(F.col("id").isNotNull().alias("k"), "id",
                                  F.xxhash64("text").alias("h"))).alias("f"))
              .orderBy("range").collect())
    if not firsts:
        return ranged.select("range", F.lit(0).alias("tail"), "id", "text").limit(0)
    order = [r.range for r in firsts]
    before = {r: order[i - 1] for i, r in enumerate(order)}
    marks = docs.sparkSession.createDataFrame(
        [(r.range, r.f.id, r.f.h, before[r.range]) for r in firsts],
        "range int, first_id long, first_h long, previous int")
    tails = (ranged.withColumn("h", F.xxhash64("text"))
             .join(F.broadcast(marks), (ranged["range"] == marks["range"])
                   & F.col("id").eqNullSafe(F.col("first_id")) & (F.col("h") == F.col("first_h")))
             .select(F.col("previous").alias("range"), F.lit(1).alias("tail"), "id", "text"))
    return ranged.select("range", F.lit(0).alias("tail"), "id", "text").unionByName(tails)


def _range_of(value: Column, cuts: list[int]) -> Column:
    """How many cuts are <= value; nulls go first."""
    if not cuts:
        return F.lit(0)

    @F.pandas_udf("int")
    def find(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, ids.to_numpy(dtype=np.int64), side="right"), dtype="int32")

    return find(F.coalesce(value, F.lit(-(1 << 63))))


def compare_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  k: int = SKETCH_SIZE) -> DataFrame:
    """Fingerprints of every text, of its edited text (the second half replaced
    by the start of the next document) and how alike text and edited text, and
    text and next text, are."""
    schema = ("id long, n_chars long, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double, "
              "distinct_shingles double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None     # (range, tail, id, text, sketch): waits for the row after it
        for batch in _slices(batches):
            texts = batch.column("text")
            found = list(sketches(texts, k))
            out, pending = [], []
            for row in zip(batch.column("range").to_pylist(), batch.column("tail").to_pylist(),
                           batch.column("id").to_pylist(), texts.to_pylist(), found):
                if held is not None and held[0] == row[0] and not held[1]:
                    out.append((held, row))
                    n = len(held[3]) // 2
                    pending.append(held[3][:len(held[3]) - n] + row[3][:n])
                held = row
            yield _compared(out, pending, k)

    rows = (with_next(docs, id_col, text_col)
            .repartition("range").sortWithinPartitions("range", "tail", "id", F.xxhash64("text")))
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def _compared(pairs: list[tuple], edited: list[str], k: int) -> pa.RecordBatch:
    changed = list(sketches(pa.array(edited, pa.string()), k))
    own = [a[4] for a, _ in pairs]
    return pa.RecordBatch.from_arrays(
        [pa.array([a[2] for a, _ in pairs], pa.int64()),
         pa.array([len(a[3]) for a, _ in pairs], pa.int64()),
         pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
         pa.array(map(encode, own), pa.string()), pa.array(map(encode, changed), pa.string()),
         pa.array([resemblance(s, c, k) for s, c in zip(own, changed)], pa.float64()),
         pa.array([resemblance(a[4], b[4], k) for a, b in pairs], pa.float64()),
         pa.array([distinct_count(s, k) for s in own], pa.float64())],
        names=["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
               "near_edited", "near_next", "distinct_shingles"])
