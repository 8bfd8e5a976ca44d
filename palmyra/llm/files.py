"""Files that tasks write side by side.

A task writes under a name of its own attempt and reports it in a result row;
only files named in the manifest (one row a file, written by Spark after the
stage) belong to the data set. A lost executor or a second attempt leaves a
file that no manifest names, which readers never open.
"""

from __future__ import annotations

import uuid

from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI (file:, hdfs:, s3:, gs:) or a plain path."""
    return pafs.FileSystem.from_uri(uri)


def make_dir(uri: str) -> str:
    store, path = open_fs(uri)
    store.create_dir(path, recursive=True)
    return uri.rstrip("/")


def attempt_name(stem: str) -> str:
    ctx = TaskContext.get()
    return f"{stem}-{ctx.partitionId():06d}-{uuid.uuid4().hex[:12]}"


def write_bytes(uri: str, data: bytes) -> None:
    store, path = open_fs(uri)
    with store.open_output_stream(path) as out:
        out.write(data)


def read_bytes(uri: str) -> bytes:
    store, path = open_fs(uri)
    with store.open_input_stream(path) as src:
        return src.read()


def commit(manifest: DataFrame, base: str) -> DataFrame:
    """Run the writing tasks and publish which files count."""
    path = f"{base}/manifest"
    manifest.write.parquet(path)
    return manifest.sparkSession.read.schema(manifest.schema).parquet(path)


def spread(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """One file a task."""
    return spark.createDataFrame(spark.sparkContext.parallelize(rows, max(1, len(rows))), schema) \
        if rows else spark.createDataFrame([], schema)
