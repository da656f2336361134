"""Change-event envelope: parse, classify, split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fields of a change event. Row images stay JSON text here; their schema belongs to the
# entity, not to the envelope.
ENVELOPE = T.StructType(
    [
        T.StructField("before", T.StringType()),
        T.StructField("after", T.StringType()),
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
        T.StructField(
            "source",
            T.StructType(
                [
                    T.StructField("db", T.StringType()),
                    T.StructField("schema", T.StringType()),
                    T.StructField("table", T.StringType()),
                    T.StructField("lsn", T.LongType()),
                    T.StructField("txId", T.LongType()),
                ]
            ),
        ),
    ]
)

# Operations that are accepted, and the columns of the dead-letter log.
CHANGE_OPS = ("c", "u", "d")
DEAD_LETTER_COLUMNS = (
    "topic",
    "kafka_partition",
    "kafka_offset",
    "raw_value",
    "error_type",
    "processed_at",
    "dlq_timestamp",
)


def parse_envelope(
    records: DataFrame, processed_at: Column | None = None, snapshot_ops: Sequence[str] = ()
) -> DataFrame:
    """Kafka-shaped records to the 18 columns of the raw log.

    A value that is not JSON yields NULL envelope fields and fails validation later.
    ``snapshot_ops`` (usually ``("r",)``) are operations of an initial snapshot to read as creates.

    The JSON is unpacked by a one-element generator: later filters on its fields stay above it,
    where a plain projection would let the optimizer copy the parser into every filter.
    """
    decoded = records.select(
        "topic",
        F.col("partition").cast("int").alias("kafka_partition"),
        F.col("offset").cast("long").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("key").cast("string").alias("record_key"),
        F.col("value").cast("string").alias("raw_value"),
    ).select("*", F.explode_outer(F.array(F.from_json("raw_value", ENVELOPE))).alias("envelope"))
    operation = F.col("envelope.op")
    if snapshot_ops:
        operation = F.when(operation.isin(*snapshot_ops), "c").otherwise(operation)
    return decoded.select(
        "topic",
        "kafka_partition",
        "kafka_offset",
        "kafka_timestamp",
        "record_key",
        "raw_value",
        operation.alias("operation"),
        F.col("envelope.before").alias("before_json"),
        F.col("envelope.after").alias("after_json"),
        F.col("envelope.source.db").alias("source_db"),
        F.col("envelope.source.schema").alias("source_schema"),
        F.col("envelope.source.table").alias("source_table"),
        F.col("envelope.source.lsn").alias("pg_lsn"),
        F.col("envelope.source.txId").alias("pg_tx_id"),
        F.col("envelope.ts_ms").alias("source_ts_ms"),
        (F.current_timestamp() if processed_at is None else processed_at).alias("processed_at"),
        F.concat_ws("-", "topic", "kafka_partition", "kafka_offset").alias("event_id"),
        F.col("envelope.source.lsn").alias("_cdc_order_lsn"),
    )


def error_type() -> Column:
    """Why an event cannot be used, NULL for a good one. The first test that holds wins."""
    return (
        F.when(F.col("operation").isNull(), "NULL_OPERATION")
        .when(~F.col("operation").isin(*CHANGE_OPS), "INVALID_OPERATION")
        .when(F.col("source_table").isNull(), "NULL_TABLE")
        .when(F.col("before_json").isNull() & F.col("after_json").isNull(), "EMPTY_PAYLOAD")
    )


def classify(events: DataFrame) -> DataFrame:
    return events.withColumn("error_type", error_type())


def good_events(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("error_type").isNull()).drop("error_type")


def dead_letters(classified: DataFrame, stamped_at: Column | None = None) -> DataFrame:
    stamp = F.current_timestamp() if stamped_at is None else stamped_at
    bad = classified.where(F.col("error_type").isNotNull()).withColumn("dlq_timestamp", stamp)
    return bad.select(*DEAD_LETTER_COLUMNS)


def split_events(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good events, dead letters)."""
    classified = classify(events)
    return good_events(classified), dead_letters(classified)


def dedupe_events(events: DataFrame, delay: str | None = None, copy_tasks: int = 0) -> DataFrame:
    """One row per broker position.

    On a stream, ``delay`` bounds the state: copies ingested at most that far apart are found.
    Without it (batch, or a stream that may keep every id) all copies are found. The watermark runs
    on the ingest clock, so no event is ever too late: an event-time watermark would drop the
    backlog of a lagging partition from the raw log.

    A batch drops copies before its shuffle. A stream sends all copies of a micro-batch to one task,
    which is fine for a small rate limit; for large micro-batches ``copy_tasks`` first drops them
    in that many tasks per event, at the price of a second state.
    """
    if delay and events.isStreaming:
        events = events.withWatermark("processed_at", delay)
        if copy_tasks:
            part = F.pmod(F.spark_partition_id(), F.lit(copy_tasks))
            events = events.withColumn("_part", part).dropDuplicatesWithinWatermark(["event_id", "_part"]).drop("_part")
        return events.dropDuplicatesWithinWatermark(["event_id"])
    return events.dropDuplicates(["event_id"])
