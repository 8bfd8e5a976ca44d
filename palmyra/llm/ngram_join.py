"""N-gram Jaccard self-join by MinHash banding.

1. Every document becomes its set of distinct five-word shingles. Documents
   with the same set are one class; its smallest id stands for it.
2. Each class gets ``bands`` band hashes of ``rows`` MinHash values; band and row
   counts follow from the threshold and the target recall. Shuffling on band
   hashes links each class to the smallest member of each bucket, so a bucket
   of n members gives n links and not n^2 pairs; the groups that hang together
   by these links hold every pair that shares a band.
3. Such a group is verified on full shingle sets, in blocks: a large group is
   dealt into blocks of bounded size, every two blocks meet in one task, and a
   block product counts the shared shingles of all its pairs. A task returns,
   per class, how many documents it is similar to and one link into its
   cluster, never the pairs.
4. The links join blocks to clusters.

All pairs of a group are verified, also those that share no band, so the recall
is above that of the bands alone. No bucket, group or partner count is capped.

Cases: a text of one to four words is one shingle; a document without words (or
null) is similar to nothing and is a cluster of its own; equal texts are
similar to each other; rows that repeat an id count as documents of their
own but share its cluster id; null ids take part, and come after all others as a
cluster's id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palmyra.llm.common import (bloom_has, bloom_of, connected_components, give_back, mix64,
                                row_keys, shingle_sets)
from palmyra.operators.skew import spread_join
from palmyra.sources.writers import cut_lineage

SHINGLE_WORDS = 5
THRESHOLD = 0.8
TARGET_RECALL = 0.999
MAX_HASHES = 384
#: A block holds about so many classes and shingles; a group of k blocks sends each
#: text k times.
BLOCK_ROWS = 1024
BLOCK_SHINGLES = 1_000_000
#: Bits of the filter on member texts, whatever their number (8 MB).
BLOOM_BITS = 1 << 26
#: Ids are carried as decimals, so that a null one can stand after all of them.
ID = "decimal(20,0)"
NULL_ID = 1 << 63
#: Texts with a word.
HAS_WORD = r"[0-9A-Za-z]|[^\x00-\x7F]"
SEED = 20_240_229


def choose_bands(threshold: float, recall: float, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows a band, so the fewest chance candidates, for
    which pairs at the threshold share a band with probability ``recall``."""
    best = (math.ceil(math.log(1 - recall) / math.log(1 - threshold)), 1) if threshold < 1 else (1, 1)
    for rows in range(1, max_hashes + 1):
        hit = threshold ** rows
        if hit <= 0:
            break
        bands = math.ceil(math.log(1 - recall) / math.log1p(-hit)) if hit < 1 else 1
        if bands * rows <= max_hashes:
            best = (bands, rows)
    return best


def _functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return (rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            rng.integers(0, 1 << 63, n, dtype=np.uint64))


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray, step: int = 4096) -> np.ndarray:
    """MinHash values; a long set goes through in steps."""
    low = np.full(len(a), np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(shingles), step):
        part = shingles[i:i + step, None] * a + b
        part ^= part >> np.uint64(32)
        np.minimum(low, part.min(axis=0), out=low)
    return low


def summarize(docs: DataFrame, id_col: str, text_col: str, bands: int, rows: int,
              words: int = SHINGLE_WORDS) -> DataFrame:
    """(row, id, text_key, set_key, n, bands) of each row; set_key, a 128-bit hash
    of the set, is null without words."""
    schema = f"row long, id {ID}, text_key long, set_key binary, n int, bands array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib
        a, b = _functions(bands * rows)
        place = mix64(np.arange(1, bands + 1, dtype=np.uint64))
        weight = mix64(np.arange(101, 101 + rows, dtype=np.uint64)) | np.uint64(1)
        keys = row_keys()
        for batch in batches:
            set_keys, sizes, bands_of = [], [], []
            for s in shingle_sets(batch.column("text"), words):
                sizes.append(len(s))
                if len(s):
                    set_keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    sig = signature(s, a, b).reshape(bands, rows)
                    bands_of.append(mix64((sig * weight).sum(axis=1, dtype=np.uint64) + place)
                                    .astype(np.int64))
                else:
                    set_keys.append(None)
                    bands_of.append(np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array([next(keys) for _ in sizes], pa.int64()), batch.column("id"),
                 batch.column("text_key"), pa.array(set_keys, pa.binary()), pa.array(sizes, pa.int32()),
                 pa.array(bands_of, pa.list_(pa.int64()))],
                names=["row", "id", "text_key", "set_key", "n", "bands"])
        give_back()

    return _keyed(docs, id_col, text_col).mapInArrow(run, schema)


def _id(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("long").cast(ID), F.lit(str(NULL_ID)).cast(ID))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text_key, text); rows of one id and different texts have two keys."""
    return docs.select(_id(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_key"), F.col(text_col).alias("text"))


def _maybe(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """The rows whose key is among the wanted ones, and a few others: a filter of
    fixed size drops the rest at the scan, so a join need not shuffle their texts."""
    shared = rows.sparkSession.sparkContext.broadcast(bloom_of(wanted, BLOOM_BITS))

    @F.pandas_udf("boolean")
    def hit(keys: pd.Series) -> pd.Series:
        filled = np.frombuffer(shared.value, dtype=np.uint64)
        return pd.Series(bloom_has(filled, keys.to_numpy(dtype=np.int64).view(np.uint64)))

    return rows.where(hit(F.col(column)))


def _similar(sets: list[np.ndarray], left: int, threshold: float, column_step: int = 8192
             ) -> np.ndarray:
    """Which pairs reach the threshold: rows are the first ``left`` sets, columns
    the others (or the same ones, if there are no others)."""
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    everything = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(everything, kind="stable")
    everything, owner = everything[order], owner[order]
    new = np.flatnonzero(np.r_[True, everything[1:] != everything[:-1]])
    counts = np.diff(np.r_[new, len(everything)])
    # Only shingles of two or more sets can count for a pair.
    column = np.repeat(np.where(counts > 1, np.cumsum(counts > 1) - 1, -1), counts)
    owner, column = owner[column >= 0], column[column >= 0]
    same = left == len(sets)
    cols = np.arange(len(sets)) if same else np.arange(left, len(sets))
    shared = np.zeros((left, len(cols)), dtype=np.float64)
    # Columns are numbered along the sorted shingles, so a step is one slice.
    width = int(column.max(initial=-1)) + 1
    column_step = min(column_step, max(width, 1))
    limits = np.searchsorted(column, np.arange(0, width, column_step))
    for i, lo in enumerate(limits):
        hi = limits[i + 1] if i + 1 < len(limits) else len(column)
        if hi > lo:
            has = np.zeros((len(sets), column_step), dtype=np.float32)
            has[owner[lo:hi], column[lo:hi] - i * column_step] = 1
            shared += has[:left] @ (has if same else has[left:]).T
    union = sizes[:left, None] + sizes[cols][None, :] - shared
    found = shared >= threshold * union - 1e-9 * union
    if same:
        np.fill_diagonal(found, False)
    return found


def _links(ids: np.ndarray, copies: np.ndarray, found: np.ndarray, left: int
           ) -> tuple[np.ndarray, np.ndarray]:
    """(root, links) of each class of a block pair: the smallest id that it hangs
    together with here, and the documents that it is similar to across the pair."""
    n = len(ids)
    cols = np.arange(n) if left == n else np.arange(left, n)
    links = np.zeros(n, dtype=np.int64)
    links[:left] += found @ copies[cols]
    if left < n:
        links[cols] += found.T @ copies[:left]
    label = ids.copy()
    while True:     # smallest label across links; rounds as the diameter, which is small
        before = label.copy()
        most = np.iinfo(np.int64).max
        np.minimum(label[:left], np.where(found, label[cols][None, :], most)
                   .min(axis=1, initial=most), out=label[:left])
        label[cols] = np.minimum(label[cols], np.where(found, label[:left][:, None], most)
                                 .min(axis=0, initial=most))
        if (label == before).all():
            return label, links


def verify(members: DataFrame, texts: DataFrame, threshold: float,
           words: int = SHINGLE_WORDS) -> DataFrame:
    """members: (id, rep, text_key, grp, copies, n) and texts: (rep, text_key, text).
    Returns per class and block pair (id, root, links)."""
    sizes = members.groupBy("grp").agg(F.count("*").alias("m"), F.sum("n").alias("s"))
    blocks = F.ceil(F.greatest(F.col("m") / BLOCK_ROWS, F.col("s") / BLOCK_SHINGLES)).cast("int")
    placed = (members.join(sizes.select("grp", blocks.alias("k")), "grp")
              .withColumn("block", F.pmod(F.xxhash64("id"), F.col("k")).cast("int")))
    # Each class goes to the k pairs of blocks that its own is part of.
    pairs = F.transform(F.sequence(F.lit(0), F.col("k") - 1),
                        lambda o: F.struct(F.least(o, F.col("block")).alias("x"),
                                           F.greatest(o, F.col("block")).alias("y")))
    dealt = (placed.join(texts, ["rep", "text_key"])
             .select("id", "grp", "copies", "block", "text", F.explode(pairs).alias("p"))
             .select("id", "copies", "text", "grp", "p.x", "p.y",
                     (F.col("block") != F.col("p.x")).alias("second")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        key = None
        for batch in batches:
            keys = list(zip(batch.column("grp").to_pylist(), batch.column("x").to_pylist(),
                            batch.column("y").to_pylist()))
            rows = zip(keys, batch.column("id").to_pylist(), batch.column("copies").to_pylist(),
                       batch.column("second").to_pylist(),
                       shingle_sets(batch.column("text"), words))
            out = []
            for k, *row in rows:
                if k != key:
                    out += _block(held, key, threshold)
                    held, key = [], k
                elif held[-1][0] == row[0]:
                    continue        # the table repeats this row
                held.append(tuple(row))
            if out:
                yield _block_rows(out)
        if held:
            yield _block_rows(_block(held, key, threshold))
        held.clear()
        give_back()

    return (dealt.repartition("grp", "x", "y").sortWithinPartitions("grp", "x", "y", "second", "id")
            .mapInArrow(run, "id long, root long, links long"))


def _block(held: list[tuple], key: tuple | None, threshold: float) -> list[tuple]:
    if not held:
        return []
    left = sum(not second for _, _, second, _ in held)
    ids = np.array([h[0] for h in held], dtype=np.int64)
    if left in (0, len(held)) and key[1] != key[2]:
        return []           # one block of the pair is empty
    found = _similar([h[3] for h in held], left, threshold)
    label, links = _links(ids, np.array([h[1] for h in held], dtype=np.int64), found, left)
    return [(i, r, n) for i, r, n in zip(ids.tolist(), label.tolist(), links.tolist()) if n]


def _block_rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                      names=["id", "root", "links"]) if rows else \
        pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 3, names=["id", "root", "links"])


def clusters_of(docs: DataFrame, id_col: str, text_col: str, threshold: float, recall: float,
                words: int) -> DataFrame:
    """(row, id, text_key, class_id, keeper, rep, n_copies, n_links) of each row;
    ``keeper`` is the row number of its cluster's first document."""
    bands, rows = choose_bands(threshold, recall)
    rows_of = cut_lineage(summarize(docs, id_col, text_col, bands, rows, words), "ngram-sets")
    classes = cut_lineage(
        rows_of.where("set_key IS NOT NULL").groupBy("set_key")
        .agg(F.min(F.struct("id", "row", "text_key")).alias("first"), F.count("*").alias("copies"),
             F.first("n").alias("n"))
        .select("set_key", F.col("first.row").alias("row"), F.col("first.id").alias("rep"),
                "first.text_key", "copies", "n"), "ngram-classes")
    # Classes go by the row number of their first document: ids may repeat.
    band = cut_lineage(rows_of.select("row", "bands")
                       .join(classes.select("row"), "row", "left_semi")
                       .select("row", F.explode("bands").alias("h")), "ngram-bands")
    buckets = (band.groupBy("h").agg(F.min("row").alias("a"), F.count("*").alias("m"))
               .where("m > 1").select("h", "a"))
    stars = (band.join(buckets, "h").where("row <> a")
             .select("a", F.col("row").alias("b")).distinct())
    groups = connected_components(stars)
    members = cut_lineage(
        classes.join(groups.select(F.col("node").alias("row"), F.col("label").alias("grp")), "row")
        .select(F.col("row").alias("id"), "rep", "text_key", "grp", "copies", "n"),
        "ngram-members")
    texts = (_maybe(_keyed(docs, id_col, text_col), "text_key", members.select("text_key"))
             .withColumnRenamed("id", "rep")
             .join(members.select("rep", "text_key"), ["rep", "text_key"], "left_semi"))
    verified = cut_lineage(verify(members, texts, threshold, words), "ngram-links")
    links = verified.groupBy("id").agg(F.sum("links").alias("links"))
    clusters = connected_components(verified.select(F.col("id").alias("a"),
                                                    F.col("root").alias("b")))
    reps = classes.select(F.col("row").alias("node"), F.col("rep").alias("rep_id"))
    named = (clusters.join(reps, "node").groupBy("label")
             .agg(F.min(F.struct("rep_id", "node")).alias("first")))
    # Only the nodes of clusters meet their cluster's first; a class that is similar to
    # nothing has none.
    firsts = spread_join(clusters, named, ["label"], "inner").select(F.col("node").alias("row"), "first")
    found = (classes
             .join(links.withColumnRenamed("id", "row"), "row", "left")
             .join(firsts, "row", "left")
             .select("set_key", F.coalesce("first.rep_id", "rep").alias("class_id"),
                     F.coalesce("first.node", "row").alias("keeper"), "rep", "copies",
                     (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    # A document without words joins nothing; its own key keeps it apart.
    key = F.coalesce("set_key", F.encode(F.concat(F.lit("row "), F.col("row")), "utf-8"))
    return (rows_of.select("row", "id", "text_key", key.alias("set_key"))
            .join(found, "set_key", "left")
            .select("row", "id", "text_key", F.coalesce("class_id", "id").alias("class_id"),
                    F.coalesce("keeper", "row").alias("keeper"), F.coalesce("rep", "id").alias("rep"),
                    F.coalesce("copies", F.lit(1)).alias("n_copies"),
                    F.coalesce("n_links", F.lit(0)).alias("n_links")))


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 threshold: float = THRESHOLD, recall: float = TARGET_RECALL,
                 words: int = SHINGLE_WORDS) -> DataFrame:
    """One row per document: id, class_id (smallest id of the cluster that links
    of at least ``threshold`` make), representative (smallest id with the same
    shingle set), n_copies (documents with that set) and n_links (other
    documents at or above the threshold, those with the same set included)."""
    def shown(c):
        return F.when(F.col(c) != F.lit(str(NULL_ID)).cast(ID), F.col(c).cast("long"))

    return clusters_of(docs, id_col, text_col, threshold, recall, words).select(
        shown("id").alias(id_col), shown("class_id").alias("class_id"),
        shown("rep").alias("representative"), "n_copies", "n_links")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             threshold: float = THRESHOLD, recall: float = TARGET_RECALL,
             words: int = SHINGLE_WORDS) -> DataFrame:
    """The rows of ``docs`` without near copies: of each cluster the document of the
    smallest id stays, with all its columns. Rows without words all stay."""
    wordy = F.coalesce(F.col(text_col).rlike(HAS_WORD), F.lit(False))
    kept = (clusters_of(docs.where(wordy), id_col, text_col, threshold, recall, words)
            .where("row = keeper").select("id", "text_key"))
    whole = docs.where(wordy).select(_id(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_key"),
                                     F.struct("*").alias("doc"))
    key = ["id", "text_key"]
    # Rows that repeat id and text would both match their keeper.
    first = whole.join(kept, key, "left_semi").dropDuplicates(key).select("doc.*")
    return first.unionByName(docs.where(~wordy))
