"""Top-1 row per group.

``row_number`` over the group, keep rank 1. Spark plans this with a partial
``WindowGroupLimit`` before the shuffle, so each map task forwards at most one
row per group: a group holding a large share of the rows costs no more shuffle
than any other. The tie-break columns make the pick deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top1(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
         tiebreak: Sequence[str] = ()) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(
        *order, *[F.col(c).asc_nulls_last() for c in tiebreak])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
