"""Ingest lag as a stream: histograms by event time that merge to any period."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chronolake.operators.quality import lag_histogram
from chronolake.streaming.ingest import _overwrite, _triggered

LAG_INTERVAL = "60 seconds"
LAG_DELAY = "24 hours"


def start_lag_writer(
    events: DataFrame,
    path: str,
    checkpoint: str,
    every: str = "1 hour",
    delay: str = LAG_DELAY,
    interval: str | None = LAG_INTERVAL,
) -> StreamingQuery:
    """Keep the lag histogram of each entity and window of the source clock, in update mode.

    A micro-batch writes the buckets that it changed, with their counts so far, into a partition of its own; a
    batch that is run again replaces it. The state holds the windows of the last ``delay`` of event time, with
    at most a few hundred buckets each; events later than that are not counted.
    """
    at = F.timestamp_millis("source_ts_ms")
    counted = lag_histogram(events.withColumn("_at", at).withWatermark("_at", delay), every, F.col("_at"))

    def write(batch: DataFrame, batch_id: int) -> None:
        _overwrite(batch.withColumn("_batch_id", F.lit(batch_id)).write.partitionBy("_batch_id")).parquet(path)

    writer = counted.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _triggered(writer.outputMode("update").queryName("lag-writer"), interval).start()


def read_lag_histogram(spark: SparkSession, path: str) -> DataFrame:
    """The newest count of each bucket that ``start_lag_writer`` has written."""
    newest = F.max_by("event_count", "_batch_id").alias("event_count")
    return spark.read.parquet(path).groupBy("source_table", "window_start", "lag_from_ms", "lag_to_ms").agg(newest)
