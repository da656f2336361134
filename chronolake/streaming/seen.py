"""A raw log without second deliveries, however far apart they come, and without state that only grows in memory."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chronolake.streaming.ingest import (
    LOG_INTERVAL,
    LOG_PARTITIONS,
    _claim,
    _overwrite,
    _owned_log,
    _triggered,
    with_ingest_date,
)

# Broker days of one micro-batch up to which the ledger is read by day.
MAX_DAYS = 366

_LEDGER = "event_id string, broker_day date, _batch_id bigint"


def start_distinct_log_writer(
    good: DataFrame, log_path: str, seen_path: str, checkpoint: str, interval: str | None = LOG_INTERVAL
) -> StreamingQuery:
    """Append good events to the raw log, each once; the first delivery stays.

    ``seen_path`` is a ledger of the event ids in the log, by broker day. A copy has its original's place and time at
    the broker, so a micro-batch reads the ledger's days that its own events fall on, nothing else: an event is
    known again after months at the cost of its day. Copies within a micro-batch are dropped before the shuffle.

    A batch looks only at ids of earlier batches and overwrites its own partitions of log and ledger, so one that
    is run again decides the same. Log, ledger and checkpoint belong together; another checkpoint is an error.
    Events without a broker time share a day of their own.
    """
    spark = good.sparkSession
    system, owner = _owned_log(spark, log_path, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        own = batch.dropDuplicates(["event_id"]).withColumn("broker_day", F.to_date("kafka_timestamp"))
        own = own.persist(StorageLevel.MEMORY_AND_DISK)
        fresh = _unseen(own, _ledger(spark, seen_path, own), batch_id).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            number = F.lit(batch_id).cast("long").alias("_batch_id")
            rows = with_ingest_date(fresh.drop("broker_day")).select("*", number).hint("rebalance", *LOG_PARTITIONS)
            _overwrite(rows.write.partitionBy(*LOG_PARTITIONS, "_batch_id")).parquet(log_path)
            ids = fresh.select("event_id", "broker_day", number).hint("rebalance", "broker_day")
            _overwrite(ids.write.partitionBy("broker_day", "_batch_id")).parquet(seen_path)
        finally:
            fresh.unpersist()
            own.unpersist()

    writer = good.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    query = _triggered(writer.outputMode("append").queryName("distinct-log-writer"), interval).start()
    _claim(system, owner, query)
    return query


def _ledger(spark: SparkSession, path: str, own: DataFrame) -> DataFrame | None:
    """The ledger's rows of the days in ``own``; with absurdly many days, all of it."""
    days = [r[0] for r in own.select("broker_day").distinct().limit(MAX_DAYS + 1).collect()]
    names = [f"{path}/broker_day={day or '__HIVE_DEFAULT_PARTITION__'}" for day in days]
    if len(days) > MAX_DAYS:
        names = [path]
    to_path = spark._jvm.org.apache.hadoop.fs.Path
    system = to_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    names = [name for name in names if system.exists(to_path(name))]
    return spark.read.schema(_LEDGER).option("basePath", path).parquet(*names) if names else None


def _unseen(own: DataFrame, ledger: DataFrame | None, batch_id: int) -> DataFrame:
    if ledger is None:
        return own
    # The copies are found first: they are few, where the ledger's days may be long.
    earlier = ledger.where(F.col("_batch_id") < batch_id).select("event_id")
    copies = earlier.join(own.select("event_id"), "event_id", "left_semi")
    return own.join(copies, "event_id", "left_anti")
