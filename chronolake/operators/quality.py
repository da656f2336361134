"""Data-quality reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronolake.functions.specs import KEY, EntitySpec
from chronolake.operators.history import end_of_validity
from chronolake.operators.skew import MAX_ROWS_PER_KEY, balance, with_neighbours

LAG_BITS = 5  # leading binary digits that a bucket of lags keeps


def null_counts(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows and NULLs per column, from one pass: ``column_name, total_rows, null_rows``."""
    nulls = [F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)]
    counted = rows.agg(F.count(F.lit(1)).alias("total_rows"), *nulls)
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("null_rows")) for i, c in enumerate(columns)]
    )
    return counted.select("total_rows", F.inline(pairs)).select("column_name", "total_rows", "null_rows")


def payload_fields(events: DataFrame, spec: EntitySpec) -> DataFrame:
    """Fields that row images hold, how often, and whether the entity declares them: schema drift."""
    image = F.when(F.col("operation") == "d", F.col("before_json")).otherwise(F.col("after_json"))
    fields = events.select(F.explode(F.json_object_keys(image)).alias("field"))
    counts = fields.groupBy("field").agg(F.count(F.lit(1)).alias("row_count"))
    return counts.withColumn("declared", F.col("field").isin(*spec.columns))


def duplicate_keys(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)


def orphans(rows: DataFrame, parents: DataFrame, references: Mapping[str, str]) -> DataFrame:
    """Reference values without a parent row, and how many rows hold them.

    Values are counted before the join, so a value that a third of all rows share joins as one row.
    """
    (child_columns, parent_columns) = list(references), list(references.values())
    values = rows.groupBy(*child_columns).agg(F.count(F.lit(1)).alias("row_count"))
    values = values.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in child_columns]))
    matches = [values[c] == parents[p] for c, p in zip(child_columns, parent_columns)]
    return values.join(parents, matches, "left_anti")


def error_counts(dead: DataFrame) -> DataFrame:
    return dead.groupBy("topic", "error_type").agg(F.count(F.lit(1)).alias("error_count"))


def acceptance(classified: DataFrame) -> DataFrame:
    """Per topic: accepted and rejected events and the rejected share."""
    counts = classified.groupBy("topic").agg(
        F.count_if(F.col("error_type").isNull()).alias("accepted"),
        F.count_if(F.col("error_type").isNotNull()).alias("rejected"),
    )
    return counts.withColumn("rejected_share", F.col("rejected") / (F.col("accepted") + F.col("rejected")))


def message_rate(events: DataFrame, every: str = "1 hour") -> DataFrame:
    """Events per entity and time window of the source clock."""
    at = F.timestamp_millis("source_ts_ms")
    counts = events.groupBy("source_table", F.window(at, every).alias("w")).agg(F.count(F.lit(1)).alias("event_count"))
    return counts.select("source_table", F.col("w.start").alias("window_start"), "event_count")


def ingest_lag(events: DataFrame) -> DataFrame:
    """Per entity: how long after the source commit its events were ingested, in milliseconds."""
    lag = F.unix_millis("processed_at") - F.col("source_ts_ms")
    counts = events.groupBy("source_table").agg(
        F.count(lag).alias("event_count"),
        F.min(lag).alias("min_lag_ms"),
        F.max(lag).alias("max_lag_ms"),
        F.sum(lag).alias("total_lag_ms"),
    )
    mean = F.col("total_lag_ms") / F.col("event_count")
    return counts.select("source_table", "event_count", "min_lag_ms", "max_lag_ms", mean.alias("avg_lag_ms"))


def lag_histogram(events: DataFrame, every: str = "1 hour", at: Column | None = None) -> DataFrame:
    """Events per entity, window of the source clock and bucket of lag, [lag_from_ms, lag_to_ms).

    A bucket is at most a sixteenth as wide as its lags, lags below 32 ms have buckets of their own, and clocks
    that run ahead count as no lag. Counts of any windows, entities or parts of a log add up.
    """
    lag = F.greatest(F.unix_millis("processed_at") - F.col("source_ts_ms"), F.lit(0))
    at = F.timestamp_millis("source_ts_ms") if at is None else at
    spare_bits = F.greatest(F.length(F.bin(lag)) - LAG_BITS, F.lit(0))
    width = F.expr("shiftleft(1L, _spare_bits)")
    rows = events.select("source_table", F.window(at, every).alias("w"), lag.alias("_lag"), spare_bits.alias("_spare_bits"))
    rows = rows.where("_lag IS NOT NULL").withColumn("_width", width)
    first = (F.col("_lag") - F.col("_lag") % F.col("_width")).alias("lag_from_ms")
    counts = rows.groupBy("source_table", "w", first, "_width").agg(F.count(F.lit(1)).alias("event_count"))
    end = F.col("lag_from_ms") + F.col("_width")
    return counts.select("source_table", F.col("w.start").alias("window_start"), "lag_from_ms", end.alias("lag_to_ms"), "event_count")


def lag_percentiles(histogram: DataFrame, *by: str, percents: Sequence[int] = (50, 95, 99)) -> DataFrame:
    """Per group: events, and for each percent the bucket end below which that many of the events lie.

    Counts are added by bucket before they are ranked, so a group is ranked over a few hundred rows.
    """
    merged = histogram.groupBy(*by, "lag_to_ms").agg(F.sum("event_count").alias("n"))
    reached = F.sum("n").over(Window.partitionBy(*by).orderBy("lag_to_ms"))
    total = F.sum("n").over(Window.partitionBy(*by))
    ranked = merged.withColumns({"_reached": reached, "_total": total})
    ends = [
        F.min(F.when(F.col("_reached") * 100 >= F.col("_total") * p, F.col("lag_to_ms"))).alias(f"p{p}_lag_ms")
        for p in percents
    ]
    return ranked.groupBy(*by).agg(F.sum("n").alias("event_count"), *ends)


def history_violations(history: DataFrame, max_rows_per_key: int = MAX_ROWS_PER_KEY) -> DataFrame:
    """Keys that break a history rule: several open rows, open flag and end disagree, or overlap.

    Sorted by start and end, some overlap exists exactly if two neighbours overlap.
    """
    spans = history.select(KEY, "_valid_from", "_valid_to", "_is_current").withColumn("_end", end_of_validity())
    parts = balance(spans, KEY, ("_valid_from", "_end"), max_rows_per_key)
    checked = _neighbour_check(parts.cold)
    if parts.hot is not None:
        checked = checked.unionByName(_neighbour_check(parts.hot))
    open_ended = F.col("_valid_to").isNull()
    report = checked.groupBy(KEY).agg(
        F.count_if(F.col("_is_current")).alias("open_rows"),
        F.count_if(F.col("_is_current") != open_ended).alias("flag_mismatches"),
        F.count_if(F.col("_overlaps")).alias("overlaps"),
    )
    return report.where((F.col("open_rows") > 1) | (F.col("flag_mismatches") > 0) | (F.col("overlaps") > 0))


def _neighbour_check(rows: DataFrame) -> DataFrame:
    rows = with_neighbours(rows, KEY, ("_valid_from", "_end"), following={"_next_from": "_valid_from"})
    return rows.select(KEY, "_valid_to", "_is_current", (F.col("_next_from") < F.col("_end")).alias("_overlaps"))


def table_stats(history: DataFrame) -> DataFrame:
    return history.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(F.col("_is_current")).alias("current_rows")
    )


STATUS_DOCUMENT = "struct<connector:struct<state:string>,tasks:array<struct<state:string>>>"


def connector_health(documents: DataFrame, status: str = "status") -> DataFrame:
    """Per connector, from its status document: state, running and failed tasks, and a verdict."""
    parsed = documents.withColumn("_s", F.from_json(status, STATUS_DOCUMENT))
    tasks_or_none = F.coalesce("_s.tasks", F.array().cast("array<struct<state:string>>"))
    states = F.transform(tasks_or_none, lambda task: F.coalesce(task["state"], F.lit("UNKNOWN")))
    state = F.coalesce("_s.connector.state", F.lit("UNKNOWN"))

    def tasks(name: str):
        return F.size(F.filter(states, lambda s: s == name))

    return parsed.select(
        "connector",
        state.alias("connector_state"),
        tasks("RUNNING").alias("tasks_running"),
        tasks("FAILED").alias("tasks_failed"),
        ((state == "RUNNING") & (tasks("FAILED") == 0)).alias("healthy"),
    )


def health_summary(health: DataFrame) -> DataFrame:
    """All connectors in one row; without connectors the set counts as healthy."""
    return health.agg(
        F.count(F.lit(1)).alias("connector_count"),
        (F.count_if(F.col("connector_state") != "RUNNING") == 0).alias("connectors_healthy"),
        F.coalesce(F.sum("tasks_failed"), F.lit(0)).alias("failed_tasks"),
    )
