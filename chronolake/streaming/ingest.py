"""Continuous ingest: records -> raw log and dead-letter log."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from chronolake.operators.envelope import classify, dead_letters, dedupe_events, good_events, parse_envelope

# Trigger intervals of the raw log and of the dead-letter log.
LOG_INTERVAL = "60 seconds"
DEAD_LETTER_INTERVAL = "120 seconds"

# How far apart two deliveries of one event may be ingested and still be recognised.
DEDUP_DELAY = "24 hours"

LOG_PARTITIONS = ("source_table", "ingest_date")

# Tasks that share the copies of one event where micro-batches are large (file backlogs).
COPY_TASKS = 64

# Dedup state on disk instead of on the heap, several open files per task instead of a sort by
# partition, no empty batches just to clean state; set before the first stream starts.
STREAM_CONF = {
    "spark.sql.maxConcurrentOutputFileWriters": "32",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def _triggered(writer: DataStreamWriter, interval: str | None) -> DataStreamWriter:
    """Every ``interval``; without one, everything available now and then stop."""
    return writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)


def with_ingest_date(events: DataFrame) -> DataFrame:
    return events.withColumn("ingest_date", F.to_date("processed_at"))


def start_log_writer(
    good: DataFrame,
    path: str,
    checkpoint: str,
    interval: str | None = LOG_INTERVAL,
    delay: str | None = DEDUP_DELAY,
    copy_tasks: int = 0,
) -> StreamingQuery:
    """Append good events, each once, to the partitioned raw log; exactly-once by the sink's commit log."""
    rows = with_ingest_date(dedupe_events(good, delay, copy_tasks))
    writer = rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    writer = writer.partitionBy(*LOG_PARTITIONS).outputMode("append").queryName("raw-log-writer")
    return _triggered(writer, interval).start()


def start_dead_letter_writer(
    dead: DataFrame, path: str, checkpoint: str, interval: str | None = DEAD_LETTER_INTERVAL
) -> StreamingQuery:
    """Append dead letters as JSON lines."""
    writer = dead.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint)
    return _triggered(writer.outputMode("append").queryName("dead-letter-writer"), interval).start()


# Names the stream that writes a log. Readers pass over files that start with an underscore.
_OWNER = "_ingest"


def _content(system, file) -> str:
    stream = system.open(file)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _owned_log(spark: SparkSession, log_path: str, checkpoint: str):
    """The file that names a log's stream, once it is sure that this checkpoint may write the log.

    Refinement goes by batch numbers, and another checkpoint would count its batches anew: everything it wrote
    would pass for read already.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    log, kept = path(log_path), path(f"{checkpoint}/metadata")
    system = log.getFileSystem(spark._jsc.hadoopConfiguration())
    own = kept.getFileSystem(spark._jsc.hadoopConfiguration())
    owner = path(log, _OWNER)
    has_rows = system.exists(log) and any(not f.getPath().getName().startswith("_") for f in system.listStatus(log))
    if has_rows and not own.exists(kept):
        raise ValueError(f"{log_path} was written with another checkpoint than {checkpoint}")
    if system.exists(owner):
        stream = json.loads(_content(own, kept))["id"] if own.exists(kept) else None
        if _content(system, owner).strip() != stream:
            raise ValueError(f"{log_path} was written with another checkpoint than {checkpoint}")
    return system, owner


def _claim(system, owner, query: StreamingQuery) -> None:
    """Name the stream in its log, if it isn't yet."""
    if not system.exists(owner):
        out = system.create(owner, False)
        out.write(bytearray(f"{query.id}\n".encode()))
        out.close()


def start_split_ingest(
    records: DataFrame,
    log_path: str,
    dead_letter_path: str,
    checkpoint: str,
    interval: str | None = LOG_INTERVAL,
    delay: str | None = DEDUP_DELAY,
    snapshot_ops: tuple[str, ...] = (),
    copy_tasks: int = 0,
) -> StreamingQuery:
    """Read and parse the source once and write both logs from each micro-batch.

    A batch writes only partitions that carry its own number and overwrites them, so a batch that
    is run again after a failure replaces its files instead of adding to them. (The batch clock is
    part of the stream's offset log, so a repeated batch also gets the same ingest date.) A log is
    written with one checkpoint only; another one is an error.
    """
    system, owner = _owned_log(records.sparkSession, log_path, checkpoint)
    classified = classify(parse_envelope(records, snapshot_ops=snapshot_ops))
    stream = dedupe_events(classified, delay, copy_tasks)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            number = F.lit(batch_id).alias("_batch_id")
            # One file for each partition, but several tasks and files where one has more bytes than a task.
            good = with_ingest_date(good_events(batch)).select("*", number).hint("rebalance", *LOG_PARTITIONS)
            _overwrite(good.write.partitionBy(*LOG_PARTITIONS, "_batch_id")).parquet(log_path)
            dead = dead_letters(batch).select("*", number)
            _overwrite(dead.write.partitionBy("_batch_id")).json(dead_letter_path)
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    query = _triggered(writer.outputMode("append").queryName("split-ingest"), interval).start()
    _claim(system, owner, query)
    return query


def _overwrite(writer):
    return writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")


def await_any(spark: SparkSession, running: Iterable[StreamingQuery]) -> None:
    """Block until one query ends; stop the others when it does or when interrupted."""
    try:
        spark.streams.awaitAnyTermination()
    except KeyboardInterrupt:
        pass
    finally:
        for query in running:
            if query.isActive:
                query.stop()


def progress_rows(query: StreamingQuery) -> list[tuple[str, int, int, float]]:
    """(query name, batch, input rows, rows per second) of the recent micro-batches."""
    return [
        (query.name, p["batchId"], p["numInputRows"], float(p.get("processedRowsPerSecond") or 0.0))
        for p in query.recentProgress
    ]
