"""Monthly balance kept current as reading files arrive (Structured Streaming).

New gauge-reading files land in a directory. Each micro-batch is appended to
the readings table under the stream's own id and the batch's number, so a
retried batch takes the place of its first try. The months from the oldest one
that the batch touches to the newest stored one are then brought up to date, as the
monthly job (P2) run for each of them in order would: a month's balance carries into the
next, so a late reading changes all of them. That is one job, whatever the number of
months, and it reads the months' partial aggregates and not their readings.

The checkpoint is required. It holds the stream's id and its place in the
landing folder; a stream without it would read every file again under a new
name. A new checkpoint is a new stream and takes all files of the folder.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from palmyra.functions.periods import period_index
from palmyra.plans.jobs import Warehouse, append_readings, run_balance_from
from palmyra.sources.tables import SCHEMAS


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """Spark writes the id once, when a stream first starts on a checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first().value)["id"]


def _ingest(wh: Warehouse, checkpoint: str, mode: str):
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        append_readings(batch, wh, _stream_id(spark, checkpoint), batch_id)
        oldest = batch.select(F.min(period_index("Tahun", "Bulan"))).first()[0]
        if oldest is not None:
            run_balance_from(spark, wh, oldest // 12, oldest % 12 + 1, mode=mode)
    return on_batch


def start_monthly_updates(spark: SparkSession, wh: Warehouse, landing: str, *,
                          checkpoint: str, mode: str = "reference",
                          available_now: bool = False,
                          interval: str = "1 hour") -> StreamingQuery:
    if not checkpoint:
        raise ValueError("the stream needs a checkpoint folder of its own")
    stream = spark.readStream.schema(SCHEMAS["readings"]).parquet(landing)
    writer = (stream.writeStream.foreachBatch(_ingest(wh, checkpoint.rstrip("/"), mode))
              .option("checkpointLocation", checkpoint))
    writer = (writer.trigger(availableNow=True) if available_now
              else writer.trigger(processingTime=interval))
    return writer.start()
