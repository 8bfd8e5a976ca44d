"""Ordered output: files in name order hold a table in order.

A global sort of the whole table as one list does not exist here; instead the rows are
dealt to tasks by sampled ranges of the sort key and sorted inside each, so file i holds
only rows before those of file i + 1. Reading the files one after the other gives the
order back, and a reader that wants the first rows opens the first file only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palmyra.sources.writers import cut_lineage


def write_ordered(df: DataFrame, path: str, by: Sequence[str | Column], *,
                  files: int | None = None) -> None:
    """Write ``df`` ordered by ``by``. Rows with equal keys lie in one file; give further
    columns in ``by`` where one key holds a large part of the rows."""
    keys = [F.col(c) if isinstance(c, str) else c for c in by]
    ranged = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*keys).write.mode("errorifexists").parquet(path)


def read_ordered(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """The rows with ``file`` (0, 1, ...: ordinal of their file by name), ``place`` in it
    and ``position`` in the whole table (from 1). Nothing is sorted: the counts of the
    files, one row each, say where each one begins."""
    reader = spark.read.schema(schema) if schema else spark.read
    rows = reader.parquet(path).select("*", F.col("_metadata.file_name").alias("_file"),
                                       F.col("_metadata.row_index").alias("place"))
    sizes = rows.groupBy("_file").agg(F.count("*").alias("_n"))
    upto = Window.orderBy("_file")
    starts = cut_lineage(sizes.select(
        "_file", (F.row_number().over(upto) - 1).alias("file"),
        F.coalesce(F.sum("_n").over(upto.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias("_before")), "file-starts")
    return (rows.join(starts, "_file")
            .withColumn("position", F.col("_before") + F.col("place") + 1).drop("_file", "_before"))
