"""Helpers shared by the text operators.

Words are maximal runs of bytes that are ASCII digits, ASCII letters (A-Z
lower-cased) or not ASCII at all, i.e. ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` on
the text with A-Z lowered. Non-ASCII characters only have bytes >= 0x80 in
UTF-8, so the split works on the Arrow byte buffer without decoding, for a
whole batch of texts at once.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palmyra.sources.writers import cut_lineage

U64 = np.uint64
CHUNK_BYTES = 1 << 20
#: An odd multiplier has an inverse modulo 2^64, which turns prefix sums into
#: hashes of any byte range.
BYTE_BASE = U64(0x9E3779B97F4A7C15)
BYTE_BASE_INV = U64(pow(int(BYTE_BASE), -1, 1 << 64))
GRAM_BASE = U64(0xD6E8FEB86659FD93)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[48:58] = True
_IS_WORD[97:123] = True
_IS_WORD[128:] = True
_AS_IS = np.arange(256, dtype=np.uint8)
_powers: dict[str, np.ndarray] = {}


def _power_table(name: str, base: np.uint64, n: int) -> np.ndarray:
    table = _powers.get(name)
    if table is None or len(table) < n:
        size = max(n, CHUNK_BYTES + 1)
        table = np.full(size, base, dtype=U64)
        table[0] = 1
        np.cumprod(table, out=table)
        if size <= 4 * CHUNK_BYTES:  # one very long text must not pin its table
            _powers[name] = table
    return table[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finalizer."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@dataclass
class Words:
    """Words of rows ``lo .. hi-1`` of a batch, in text order."""

    lo: int
    hi: int
    data: np.ndarray      # lower-cased bytes of the rows, back to back
    hashes: np.ndarray    # one 64-bit hash a word
    starts: np.ndarray    # byte range of each word in data
    ends: np.ndarray
    first: np.ndarray     # first word of each row; hi - lo + 1 entries
    rows: np.ndarray      # first byte of each row in data; hi - lo + 1 entries

    def text(self, a: int, b: int) -> list[str]:
        raw = self.data
        return [raw[s:e].tobytes().decode("utf-8", "replace")
                for s, e in zip(self.starts[a:b], self.ends[a:b])]


def utf8_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string array; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return off, raw


def all_bytes_but(marks: bytes) -> np.ndarray:
    """Table of the bytes that words are made of, where they end at ``marks``."""
    inside = np.ones(256, dtype=bool)
    inside[list(marks)] = False
    return inside


def iter_words(texts: pa.Array, inside: np.ndarray = _IS_WORD, lower: bool = True
               ) -> Iterator[Words]:
    """Words of every text, in runs of rows of about CHUNK_BYTES (a longer
    text makes a run of its own). ``inside`` says which bytes words are made of."""
    if not len(texts):
        return
    off, raw = utf8_buffers(texts)
    lo, n = 0, len(texts)
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + CHUNK_BYTES, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield _split(lo, hi, raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], inside, lower)
        lo = hi


def _split(lo: int, hi: int, raw: np.ndarray, off: np.ndarray, members: np.ndarray,
           lower: bool) -> Words:
    data = (_LOWER if lower else _AS_IS)[raw]
    n = len(data)
    inside = np.zeros(n + 2, dtype=bool)
    inside[1:-1] = members[data]
    row_start = np.zeros(n + 1, dtype=bool)
    row_start[off] = True
    edge = ~inside[:-1] | row_start           # edge[i]: a word may begin at byte i
    starts = np.flatnonzero(inside[1:-1] & edge[:-1])
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | row_start[1:])) + 1
    total = np.zeros(n + 1, dtype=U64)
    np.cumsum((data.astype(U64) + U64(1)) * _power_table("up", BYTE_BASE, n), out=total[1:])
    down = _power_table("down", BYTE_BASE_INV, n + 1)
    hashes = mix64((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U64))
    return Words(lo, hi, data, hashes, starts, ends, np.searchsorted(starts, off), off)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position (len - k + 1 values)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, U64)
    out = words[:n].copy()
    for j in range(1, k):
        out = out * GRAM_BASE + words[j:j + n]
    return mix64(out)


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """For each text its distinct k-word shingle hashes, ascending. A text of
    fewer than k words, but not none, is one shingle; one without words (or
    null) has no shingle."""
    for w in iter_words(texts):
        grams = gram_hashes(w.hashes, k)
        for a, b in zip(w.first[:-1], w.first[1:]):
            if b - a >= k:
                yield np.unique(grams[a:b - k + 1])
            else:
                yield gram_hashes(w.hashes[a:b], int(b - a)) if b > a else np.empty(0, U64)


#: Arrow batches of texts, where the submitter has set nothing: a batch of very long
#: texts is bounded in bytes too.
ARROW_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
                 "spark.sql.execution.arrow.maxBytesPerBatch": "16m"}


def prepare_workers(spark: SparkSession) -> None:
    """Settings and code that the Python workers of the operators need."""
    submitted = spark.sparkContext.getConf()
    for k, v in ARROW_BATCHES.items():
        if not submitted.contains(k):
            spark.conf.set(k, v)
    ship_package(spark)


def give_back() -> None:
    """Hand freed memory back to the system at the end of a partition: Spark keeps
    Python workers for later stages, beside the executor's heap."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, unless their path has it already
    (spark-submit --py-files, or PYTHONPATH)."""
    package = Path(__file__).resolve().parent.parent
    sc = spark.sparkContext
    name = f"{package.name}-package.zip"
    on_path = str(package.parent) in os.environ.get("PYTHONPATH", "").split(":")
    if on_path or any(f.endswith(name) for f in sc.listFiles):
        return
    target = Path(tempfile.mkdtemp(prefix="package-")) / name
    with zipfile.ZipFile(target, "w") as out:
        for f in sorted(package.rglob("*.py")):
            out.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(target))


def row_keys() -> Iterator[int]:
    """Numbers that no other task of the stage gives. Only for rows that are
    written before they are used twice."""
    key = TaskContext.get().partitionId() << 36
    while True:
        yield key
        key += 1


BLOOM_PROBES = 3


def bloom_probes(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Bit numbers of each 64-bit hash, one row a probe."""
    step = (hashes >> U64(32)) | U64(1)
    return np.stack([(hashes + U64(i) * step) % U64(bits) for i in range(BLOOM_PROBES)])


def bloom_of(hashes: DataFrame, bits: int) -> bytes:
    """Bloom filter of a frame with one column of 64-bit hashes. Each task sets its
    bits, a distributed ``bit_or`` unites them, and at most bits / 64 words are
    gathered, whatever the number of hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(U64)
            at = np.unique(bloom_probes(mix64(keys), bits))
            yield pa.RecordBatch.from_arrays(
                [pa.array((at >> U64(6)).astype(np.int64)),
                 pa.array((U64(1) << (at & U64(63))).view(np.int64))], names=["word", "bits"])

    found = (hashes.distinct().mapInArrow(run, "word long, bits long")
             .groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow())
    words = np.zeros(bits // 64, dtype=np.int64)
    words[found["word"].to_numpy()] = found["bits"].to_numpy()
    return words.tobytes()


def bloom_has(filled: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes may be among those of the filter (64-bit words)."""
    at = bloom_probes(mix64(hashes), 64 * len(filled))
    return ((filled[at >> U64(6)] >> (at & U64(63))) & U64(1)).all(axis=0)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Label every node of ``edges`` (a, b) with the smallest node that it
    reaches: (node, label).

    Each round hooks every node to its smallest neighbour, follows those hooks to
    their roots, and goes on with the edges between different roots only, so a
    large group costs its edges once. Rounds and hook lengths are logarithmic. Each
    step is written to the shared folder, which cuts the lineage; none gathers a
    component: a step is a join and a minimum, both by node.
    """
    pairs = cut_lineage(_ordered(edges.select("a", "b")), "cc-edges")
    found = pairs.select(F.col("a").alias("node"), F.col("b").alias("label")).limit(0)
    for level in range(max_rounds):
        if not pairs.limit(1).count():
            return found
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        roots = _roots(cut_lineage(both.groupBy(F.col("a").alias("node"))
                                   .agg(F.least(F.min("b"), F.first("a")).alias("label")),
                                   "cc-hooks"), max_rounds)
        up = roots.select(F.col("node").alias("label"), F.col("label").alias("root"))
        found = roots if level == 0 else cut_lineage(
            found.join(up, "label", "left")
            .select("node", F.coalesce("root", "label").alias("label")), "cc-labels")
        pairs = cut_lineage(_ordered(
            pairs.join(up.select(F.col("label").alias("a"), F.col("root").alias("ra")), "a")
            .join(up.select(F.col("label").alias("b"), F.col("root").alias("rb")), "b")
            .select(F.col("ra").alias("a"), F.col("rb").alias("b"))), "cc-edges")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _ordered(edges: DataFrame) -> DataFrame:
    """Each edge once, the smaller node first, without loops."""
    return (edges.where("a <> b")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def _roots(hooks: DataFrame, max_rounds: int) -> DataFrame:
    """Follow each node's label to the end; every label is a node, a smaller one or
    the node itself. Each pass doubles the steps followed."""
    for _ in range(max_rounds):
        up = hooks.select(F.col("node").alias("label"), F.col("label").alias("root"))
        passed = cut_lineage(hooks.join(up, "label").select(
            "node", F.col("root").alias("label"), (F.col("root") < F.col("label")).alias("moved")),
            "cc-hooks")
        hooks = passed.select("node", "label")
        if not passed.where("moved").limit(1).count():
            return hooks
    raise RuntimeError(f"hooks did not settle in {max_rounds} passes")
