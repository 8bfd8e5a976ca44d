"""Weighted rendezvous sharding of records by a stable key.

Each shard draws a score from the hash of (key, shard); the smallest
``-ln(u) / weight`` takes the record. So a shard holds its share of the weights,
key and weights alone decide, and a shard that is added only takes
records into itself, from all others in proportion.

Slots number the records of a shard from 0 without gaps, ordered by key. No shard
is numbered in one task: records fall into ``buckets`` by key hash, the buckets
are counted per shard, and a record's slot is its bucket's first slot plus its
place in the bucket.

Cases: a null text has no bytes; null keys hash alike and lie in one shard, and so
do rows that repeat a key, each with a slot of its own (ordered by key, then
by text hash); an empty table gives no rows; weights must be positive.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Added to each record's text bytes.
RECORD_BYTES = 8
#: Buckets a shard at least, and rows a bucket on average beyond that.
LEAST_BUCKETS = 64
BUCKET_ROWS = 20_000


def shard_of(key: Column, weights: Sequence[float], seed: int = 0) -> Column:
    """Shard 0 .. len(weights) - 1 of a key."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive, at least one")

    def score(i: int, weight: float) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(seed), F.lit(i)), 11)
        u = (bits.cast("double") + F.lit(0.5)) * F.lit(2.0 ** -53)
        return F.struct((-F.log(u) / F.lit(float(weight))).alias("s"), F.lit(i).alias("shard"))

    return F.array_min(F.array(*(score(i, w) for i, w in enumerate(weights))))["shard"]


def number(rows: DataFrame, shard: str, order: list[Column], key: Column, n_shards: int
           ) -> DataFrame:
    """Add ``slot``: the place of each row in its shard, by bucket and ``order``."""
    total = rows.agg(F.count("*")).first()[0]
    buckets = max(LEAST_BUCKETS, total // (BUCKET_ROWS * n_shards))
    placed = rows.withColumn("_bucket", F.pmod(F.xxhash64(key, F.lit(1)), F.lit(buckets)))
    counts = placed.groupBy(shard, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(shard).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(shard, "_bucket",
                          F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    place = F.row_number().over(Window.partitionBy(shard, "_bucket").orderBy(*order)) - 1
    return (placed.withColumn("_place", place).join(first, [shard, "_bucket"])
            .withColumn("slot", (F.col("_first") + F.col("_place")).cast("long"))
            .drop("_bucket", "_first", "_place"))


def assign(docs: DataFrame, weights: Sequence[float], id_col: str = "doc_id",
           text_col: str = "text", grown_weight: float = 1.0, seed: int = 0) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) of every row. Only
    id, size and checksum are shuffled, never texts."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.col("key")
    rows = docs.select(F.col(id_col).alias("key"),
                       (F.octet_length(text) + RECORD_BYTES).cast("long").alias("size"),
                       F.crc32(F.encode(text, "utf-8")).alias("text_crc32"),
                       F.lit("key").alias("law"))
    rows = (rows.withColumn("shard", shard_of(key, weights, seed))
            .withColumn("grown_shard", shard_of(key, [*weights, grown_weight], seed)))
    out = number(rows, "shard", [key, F.col("text_crc32"), F.col("size")], key, len(weights))
    return out.select(key.alias(id_col), "size", "text_crc32", "law", "shard", "slot",
                      "grown_shard")
