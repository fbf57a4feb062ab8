"""The append-only journal: latest state by batch or by stream, and windowed counts with a watermark.

The streaming forms are additions over the same journal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def latest_state(events: DataFrame, key: str, time: str, tie: str, values: list[str]) -> DataFrame:
    """The values of each key's last event by (time, tie)."""
    last = F.max(F.struct(F.col(time), F.col(tie), *values)).alias("e")
    return events.groupBy(key).agg(last, F.count(F.lit(1)).alias("events")).select(key, *(F.col(f"e.{v}").alias(v) for v in [time, tie, *values]), "events")


def stream_of(spark: SparkSession, path: str, schema, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def windowed_counts(events: DataFrame, time: str, kind: str, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events and their value by window and kind; the watermark bounds the state of a stream."""
    rows = events.withWatermark(time, late) if events.isStreaming else events
    return rows.groupBy(F.window(time, window).alias("w"), kind).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), kind, "n", "total")


def run_latest_state(stream: DataFrame, path: str, checkpoint: str, key: str, time: str, tie: str, values: list[str]) -> None:
    """Each micro-batch's last states are appended under ``path``; readers take :func:`latest_state` over them.

    Appending compacted batches keeps the sink idempotent by batch id and needs no unbounded state.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        latest_state(batch, key, time, tie, values).write.mode("overwrite").parquet(f"{path}/batch={epoch}")

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
