"""A stream of facts joined with the versions that were valid at their times."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from chronolake.operators.history import fact_join
from chronolake.streaming.ingest import _claim, _overwrite, _owned_log, _triggered

FACT_INTERVAL = "60 seconds"
CHANGE_DELAY = "1 day"


def settled_until(history: DataFrame, delay: str = CHANGE_DELAY) -> Column:
    """Event time up to which no version can change, if changes are at most ``delay`` late; NULL without versions."""
    newest = F.max(F.greatest("_valid_from", "_valid_to"))
    mark = history.agg(F.unix_micros(newest - F.expr(f"INTERVAL {delay}"))).first()[0]
    return F.timestamp_micros(F.lit(mark).cast("long"))


def start_fact_writer(
    facts: DataFrame,
    history: Callable[[], DataFrame],
    fact_key: str,
    fact_time: str,
    version_columns: Sequence[str],
    path: str,
    checkpoint: str,
    delay: str = CHANGE_DELAY,
    interval: str | None = FACT_INTERVAL,
) -> StreamingQuery:
    """Write each fact with its version (its start and ``version_columns``) once that can't change any more.

    The version's end is left out: an open one gets its end later, whatever the delay.
    ``history`` gives the row history as it is now (a silver view, say); it is read in each micro-batch. Facts at or
    before ``settled_until`` are joined and written for good, later ones wait in the shared folder for a
    following batch: what a batch costs grows with its own facts and those of the last ``delay``. Both
    go through ``fact_join``: no state in memory, and hot keys are split. A fact without a time has no version.

    A batch reads what its predecessor left waiting and overwrites its own output, so it can be run again. The
    waiting facts are written last; what ``read_facts`` takes for the newest batch is complete.
    """
    spark, columns = facts.sparkSession, facts.columns
    system, owner = _owned_log(spark, f"{path}/settled", checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch_id:
            earlier = spark.read.schema(facts.schema).parquet(f"{path}/waiting/{batch_id - 1}")
            batch = batch.unionByName(earlier)
        versions = history()
        at = F.col(fact_time).cast("timestamp")
        settled = at.isNull() | F.coalesce(at <= settled_until(versions, delay), F.lit(False))
        batch = batch.withColumn("_settled", settled).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            joined = fact_join(batch.where("_settled").select(columns), versions, fact_key, fact_time, version_columns)
            rows = joined.drop("_valid_to").withColumn("_batch_id", F.lit(batch_id).cast("long"))
            _overwrite(rows.write.partitionBy("_batch_id")).parquet(f"{path}/settled")
            batch.where(~F.col("_settled")).select(columns).write.mode("overwrite").parquet(f"{path}/waiting/{batch_id}")
        finally:
            batch.unpersist()

    writer = facts.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    query = _triggered(writer.outputMode("append").queryName("fact-writer"), interval).start()
    _claim(system, owner, query)
    return query


def read_facts(
    spark: SparkSession,
    path: str,
    facts: DataFrame,
    history: DataFrame,
    fact_key: str,
    fact_time: str,
    version_columns: Sequence[str],
) -> DataFrame:
    """All facts up to the newest complete batch: the settled ones as written, the waiting ones as of now.

    ``facts`` gives the layout of the stream; ``settled`` tells which rows can't change.
    """
    empty = fact_join(facts.limit(0), history, fact_key, fact_time, version_columns).drop("_valid_to")
    last = _newest_batch(spark, f"{path}/waiting")
    if last is None:
        return empty.withColumn("settled", F.lit(True))
    layout = T.StructType([*empty.schema.fields, T.StructField("_batch_id", T.LongType())])
    written = spark.read.schema(layout).parquet(f"{path}/settled")
    written = written.where(F.col("_batch_id") <= last).drop("_batch_id").withColumn("settled", F.lit(True))
    waiting = spark.read.schema(facts.schema).parquet(f"{path}/waiting/{last}")
    waiting = fact_join(waiting, history, fact_key, fact_time, version_columns).drop("_valid_to")
    return written.unionByName(waiting.withColumn("settled", F.lit(False)))


def _newest_batch(spark: SparkSession, folder: str) -> int | None:
    to_path = spark._jvm.org.apache.hadoop.fs.Path
    system = to_path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(to_path(folder)):
        return None
    numbers = [int(entry.getPath().getName()) for entry in system.listStatus(to_path(folder))]
    return max((n for n in numbers if system.exists(to_path(f"{folder}/{n}/_SUCCESS"))), default=None)
