"""Incremental loads with Structured Streaming: each micro-batch becomes one committed batch.

The stream's own checkpoint says which files were read; the batch log makes a repeated micro-batch
a no-op.  An extension: the batch engine needs no streams.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidewell.functions.identity import batch_id, content_hash
from tidewell.plans.batches import Action, Batch, BatchLog


def read_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def load(stream: DataFrame, log: BatchLog, folder: str, checkpoint: str) -> StreamingQuery:
    """Reads all that is there and ends; a later call goes on after it."""

    def write(rows: DataFrame, epoch: int) -> None:
        if rows.isEmpty():
            return
        digest, name = content_hash(rows), batch_id(folder, "epoch", epoch, epoch, checkpoint)
        if log.resolve(name, digest) is Action.WRITE:
            path = log.store.path(f"{folder}/batch_id={name}")
            rows.write.mode("overwrite").parquet(path)
            log.commit(Batch(epoch + 1, epoch or None, epoch + 1, name), digest, rows.sparkSession.read.parquet(path).count())

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events and their values per window and type; rows later than the watermark are left out."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))  # watermarks need a time zone
    return timed.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("events"), F.sum("value").alias("value"))
