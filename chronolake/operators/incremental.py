"""Incremental reads of the raw log.

``unconsumed`` is what pipelines use: it goes by what has been read, so late, undated and wrongly dated
events are read like any others. ``incremental_slice`` goes by event time, for reports on recent events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: how far below the high-water mark a run reads again, for late events.
LOOKBACK_MS = 3_600_000


# What a log numbers its deliveries by: the ingest's micro-batch where the log has it, else the ingest clock
# in microseconds. Both rise with every batch; event times don't.
BATCH = "_batch_id"
INGEST_CLOCK = "processed_at"


def consumption(log: DataFrame) -> Column:
    """The delivery number of each event (bigint)."""
    if BATCH in log.columns:
        return F.col(BATCH).cast("bigint")
    return F.unix_micros(F.col(INGEST_CLOCK).cast("timestamp"))


def unconsumed(log: DataFrame, entity: str, consumed: int | None) -> DataFrame:
    """Events of one entity that no committed run has read; all of them without a mark.

    The mark is a literal: the entity and the batch prune partitions. Where the log is numbered by the
    ingest clock, its days prune partitions, too. Events without a number are always read again.
    """
    rows = log.where(F.col("source_table") == entity)
    if consumed is None:
        return rows
    if BATCH in log.columns:
        return rows.where((F.col(BATCH) > consumed) | F.col(BATCH).isNull())
    clock = F.col(INGEST_CLOCK).cast("timestamp")
    mark = F.timestamp_micros(F.lit(consumed))
    rows = rows.where((clock > mark) | clock.isNull())
    if "ingest_date" in log.columns:
        rows = rows.where((F.col("ingest_date") >= F.to_date(mark)) | F.col("ingest_date").isNull())
    return rows


def high_watermark(rows: DataFrame) -> DataFrame:
    return rows.agg(F.max("source_ts_ms").alias("watermark"))


def read_watermark(rows: DataFrame) -> int | None:
    """The mark as a value (a one-row read), so that the next scan can filter on a literal."""
    return high_watermark(rows).first()["watermark"]


def incremental_slice(
    log: DataFrame,
    entity: str,
    watermark: int | None,
    lookback_ms: int = LOOKBACK_MS,
    clock_slack_days: int = 1,
) -> DataFrame:
    """Events of one entity above ``watermark - lookback_ms``; all of them without a mark.

    Both predicates are literals: the entity prunes partitions, the time bound skips row groups.
    Where the log has ``ingest_date`` partitions, days that lie wholly before the bound are pruned
    too: an event is ingested after it happened, give or take ``clock_slack_days`` of clock drift.
    """
    rows = log.where(F.col("source_table") == entity)
    if watermark is None:
        return rows
    bound = watermark - lookback_ms
    rows = rows.where(F.col("source_ts_ms") > bound)
    if "ingest_date" in log.columns:
        first_day = F.date_sub(F.to_date(F.timestamp_millis(F.lit(bound))), clock_slack_days)
        rows = rows.where(F.col("ingest_date") >= first_day)
    return rows
