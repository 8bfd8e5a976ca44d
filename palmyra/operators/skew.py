"""Joins whose keys may be null or hot.

A shuffle join sends every row of a key to one task, and every null key to the same
one. :func:`spread_join` takes the rows that cannot match round the join, and deals the
rows of a hot key over several tasks, to each of which the other side's rows of that key
are replicated. Both work without adaptive execution and without a broadcast of either
side. A key is hot when it holds more than a small part of what a task holds on average,
so there are at most ``PART`` hot keys a shuffle partition; only their list is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is hot beyond this part (one nth) of a mean task, and is dealt in such parts.
PART = 8


def has_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.col(c).isNull() for c in columns))


def hot_keys(rows: DataFrame, on: Sequence[str], tasks: int, part: int = PART,
             counts: DataFrame | None = None) -> DataFrame:
    """(keys, _parts) of the keys that hold more than ``1 / (part * tasks)`` of the rows;
    so at most ``part * tasks`` of them. Counted with partial aggregates unless
    ``counts`` (keys, _rows) is known; lazy."""
    if counts is None:
        counts = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
    share = F.lit(part * tasks) * F.col("_rows") / counts.select(F.sum("_rows")).scalar()
    return counts.withColumn("_parts", F.ceil(share)).where("_parts > 1").select(*on, "_parts")


def spread_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left", *,
                tasks: int | None = None, hot_left: bool = True,
                counts: DataFrame | None = None) -> DataFrame:
    """``left.join(right, on, how)`` (left, inner, left_semi or left_anti), whatever the
    keys of ``left``. ``right`` should have few rows of each hot key, as they are
    replicated; ``hot_left=False`` only takes null keys round the join. ``counts`` (keys,
    _rows), if known, spares counting the keys of ``left``.

    Rows are dealt by a hash of themselves and of the task that holds them, so a task
    that runs again deals them alike."""
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"how={how!r}: a spread join keeps rows of the left side only")
    on = list(on)
    keyless, rows = left.where(has_null(on)), left.where(~has_null(on))
    other = right.where(~has_null(on))
    if hot_left:
        tasks = tasks or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        hot = F.broadcast(hot_keys(rows, on, tasks, counts=counts))
        dealt = F.xxhash64(*rows.columns, F.spark_partition_id())
        rows = (rows.join(hot, on, "left")
                .withColumn("_part", F.when(F.col("_parts").isNotNull(), F.pmod(dealt, "_parts"))
                            .otherwise(F.lit(0).cast("long"))).drop("_parts"))
        # Every row is there for part 0; only those of hot keys are replicated.
        more = (other.join(hot, on).withColumn("_part", F.explode(F.sequence(
            F.lit(1).cast("long"), F.col("_parts").cast("long") - 1))).drop("_parts"))
        other = other.withColumn("_part", F.lit(0).cast("long")).unionByName(more)
        joined = rows.join(other, [*on, "_part"], how).drop("_part")
    else:
        joined = rows.join(other, on, how)
    if how in ("inner", "left_semi"):
        return joined
    if how == "left":
        added = [f for f in right.schema.fields if f.name not in on]
        keyless = keyless.select("*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in added))
    return joined.unionByName(keyless.select(*joined.columns))
