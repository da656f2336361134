"""The registered queries: each operator applied to the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronolake.checks import inputs as data
from chronolake.checks.inputs import ACCOUNT, STATUS, VISIT, instant, table
from chronolake.functions.specs import CLOSE, ENTITIES
from chronolake.jobs.publish import publish_all
from chronolake.operators import quality
from chronolake.operators.decode import decode_payload, latest_per_key, with_row_hash
from chronolake.operators.envelope import (
    classify,
    dead_letters,
    dedupe_events,
    parse_envelope,
    split_events,
)
from chronolake.operators.history import (
    as_of,
    build_history,
    current_rows,
    fact_join,
    history_spine,
    last_closed,
    splice_late,
)
from chronolake.operators.incremental import high_watermark, incremental_slice, read_watermark
from chronolake.operators.schemas import observed_fields, schema_changes
from chronolake.operators.scd2 import advance_fences, apply_scd2, empty_silver, plan_actions, unseen_rows
from chronolake.plans.distincts import customer_days, distinct_customers
from chronolake.plans.increments import OrderTotals
from chronolake.plans.marts import (
    Segments,
    Tiers,
    daily_sales,
    product_analytics,
    product_days,
    top_products,
    user_analytics,
)
from chronolake.session import fresh_folder, stored
from chronolake.sources.snapshot_trees import diff_trees, write_snapshot
from chronolake.sources.snapshots import diff_snapshots, envelope_json, snapshot_to_events
from chronolake.streaming.facts import read_facts, start_fact_writer
from chronolake.streaming.ingest import COPY_TASKS, start_dead_letter_writer, start_log_writer, start_split_ingest
from chronolake.streaming.lag import read_lag_histogram, start_lag_writer
from chronolake.streaming.seen import start_distinct_log_writer
from chronolake.warehouse import SilverTable, compact_log, ensure_log_table, recover

Query = Callable[[SparkSession, str], DataFrame]

CUT = "2024-01-16"
AFTER = "2024-02-01"
TODAY = "2024-01-31"
TODAY_H = "2001-08-01"
DAY_MS = 86_400_000

SEGMENTS_H = Segments(vip=3_500_000, loyal=2_500_000, frequent=10)
TIERS_H = Tiers(star=2_000_000, good=1_700_000, average=1_400_000)

_REGISTRY: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    """Register a query. Its instants are handed out without a zone, in UTC."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            rows = build(spark, folder.rstrip("/"))
            zoned = [f.name for f in rows.schema if isinstance(f.dataType, T.TimestampType)]
            return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else rows

        _REGISTRY[name] = run
        return build

    return register


def registered() -> dict[str, Query]:
    return dict(_REGISTRY)


# --- envelope and validation -----------------------------------------------------------------


@query("parse_envelope")
def parse_envelope_all(spark, folder):
    return data.parsed_log(spark, folder)


@query("validate_split")
def validate_split(spark, folder):
    good, _ = split_events(data.parsed_log(spark, folder, damaged=True))
    return good.select("event_id", "operation", "source_table", "before_json", "after_json", "source_ts_ms")


@query("dlq_errors")
def dlq_errors(spark, folder):
    classified = classify(data.parsed_log(spark, folder, damaged=True))
    return dead_letters(classified, instant(AFTER))


@query("dq_error_counts")
def dq_error_counts(spark, folder):
    return quality.error_counts(dead_letters(classify(data.parsed_log(spark, folder, damaged=True))))


@query("dq_acceptance")
def dq_acceptance(spark, folder):
    return quality.acceptance(classify(data.parsed_log(spark, folder, damaged=True)))


@query("dedupe_events")
def dedupe_delivered_twice(spark, folder):
    log = data.parsed_log(spark, folder)
    return dedupe_events(log.unionByName(log)).select("event_id", "kafka_offset", "raw_value")


# --- incremental reads -----------------------------------------------------------------------


@query("high_watermark")
def high_watermark_of_log(spark, folder):
    return high_watermark(data.parsed_log(spark, folder))


@query("incremental_slice")
def incremental_slice_hour(spark, folder):
    log = data.parsed_log(spark, folder)
    return incremental_slice(log, "users", read_watermark(log)).select("event_id", "source_ts_ms", "operation")


@query("incremental_slice_day")
def incremental_slice_day(spark, folder):
    log = data.parsed_log(spark, folder)
    rows = incremental_slice(log, "users", read_watermark(log), lookback_ms=DAY_MS)
    return rows.select("event_id", "source_ts_ms", "operation")


# --- the table path: catalog, runs, views ---------------------------------------------------


def _fresh_silver(spark) -> SilverTable:
    """A silver table in a database of its own."""
    database = f"checks_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{fresh_folder(spark, database)}'")
    return SilverTable(database, STATUS, 8)


def _refined(spark, folder, batches):
    """Refine (rows, validity stamp) pairs in turn into a new silver table."""
    silver, log = _fresh_silver(spark), None
    for number, (rows, stamp) in enumerate(batches):
        rows = rows.withColumn("_batch_id", F.lit(number).cast("bigint"))
        log = rows if log is None else log.unionByName(rows)
        silver.refine(log, stamp)
    return spark.table(silver.view)


@query("silver_after_two_runs")
def silver_after_two_runs(spark, folder):
    log = stored(data.parsed_log(spark, folder), "log")
    early = F.col("kafka_timestamp") < instant(CUT)
    return _refined(spark, folder, [(log.where(early), instant(CUT)), (log.where(~early), instant(AFTER))])


def _in_two_batches(spark, folder) -> DataFrame:
    log = stored(data.parsed_log(spark, folder), "log")
    return log.withColumn("_batch_id", (F.col("kafka_timestamp") >= instant(CUT)).cast("bigint"))


@query("silver_after_compaction")
def silver_after_compaction(spark, folder):
    """Two runs with a fold between them; the table as it is then, and after a second fold."""
    log, silver = _in_two_batches(spark, folder), _fresh_silver(spark)
    silver.refine(log.where("_batch_id = 0"), instant(CUT))
    silver.fold(spark, 0)
    silver.refine(log, instant(AFTER))
    before = stored(spark.table(silver.view), "before")
    silver.fold(spark, 0)
    after = spark.table(silver.view).withColumn("written", F.lit("folded"))
    return before.withColumn("written", F.lit("appended")).unionByName(after)


@query("rebuild_then_merge")
def rebuild_then_merge(spark, folder):
    """The complete history of the first batch, replacing a run over it, and one step with the second batch."""
    log, silver = _in_two_batches(spark, folder), _fresh_silver(spark)
    silver.refine(log.where("_batch_id = 0"), instant(CUT))
    silver.rebuild(log.where("_batch_id = 0"))
    silver.refine(log, instant(AFTER))
    return spark.table(silver.view)


@query("refine_late_events")
def refine_late_events(spark, folder):
    """Two thirds of the keys reach the log after events of later times have been consumed, some undated."""
    log = stored(data.parsed_log(spark, folder), "log")
    part = F.pmod(F.crc32(F.get_json_object(F.coalesce("after_json", "before_json"), "$.id").cast("binary")), F.lit(3))
    dated = log.withColumn("source_ts_ms", F.when(F.col("kafka_offset") % 10 != 0, F.col("source_ts_ms")))
    batches = [(dated.where(F.coalesce(part, F.lit(0)) == i), instant(AFTER)) for i in range(3)]
    return _refined(spark, folder, batches).where("_is_current").select("id", "status", "pg_lsn")


# --- typed rows ------------------------------------------------------------------------------


@query("decode_payload")
def decode_payload_all(spark, folder):
    return data.decoded_log(spark, folder, ACCOUNT)


@query("decode_connector_types")
def decode_connector_types(spark, folder):
    """Order totals less 200,000 as a connector encodes them: base64 of the unscaled number; times in microseconds."""
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint") - 20_000_000
    size = F.expr("CASE WHEN c BETWEEN -8388608 AND 8388607 THEN 3 ELSE 8 END")
    low = F.expr("unhex(right(lpad(hex(c), 16, '0'), 2 * size))")
    encoded = table(spark, folder, "orders").select("o_orderkey", cents.alias("c")).withColumn("size", size)
    encoded = encoded.select("o_orderkey", F.base64(low).alias("text"), (F.col("o_orderkey") * 1000 + 999).alias("micros"))
    payload = F.to_json(
        F.struct(F.col("o_orderkey").alias("id"), F.col("text").alias("total_amount"), F.col("micros").alias("created_at"))
    )
    spec = ENTITIES["orders"].as_connector({"total_amount": 2}, ("created_at",))
    rows = encoded.select(F.from_json(payload, spec.payload_schema()).alias("p"))
    return rows.select(*spec.typed("p")).select("id", "total_amount", "created_at")


@query("derive_email_domain")
def derive_email_domain(spark, folder):
    return data.customers(spark, folder).select("id", "email", "email_domain")


@query("derive_price_category")
def derive_price_category(spark, folder):
    rows = table(spark, folder, "events").select("event_id", F.col("value").alias("price"))
    return rows.withColumn("price_category", data.PRICE_RULE.build())


@query("derive_order_category")
def derive_order_category(spark, folder):
    rows = table(spark, folder, "events").select("event_id", F.col("value").alias("total_amount"))
    return rows.withColumn("order_value_category", data.ORDER_RULE.build())


@query("row_hash")
def row_hash(spark, folder):
    return with_row_hash(data.decoded_log(spark, folder, VISIT), VISIT).select("kafka_offset", "id", "_hash")


@query("latest_per_key")
def latest_event_per_key(spark, folder):
    rows = latest_per_key(data.decoded_log(spark, folder, VISIT))
    return rows.select("id", "status", "k", "is_active", "operation", "source_ts_ms", "kafka_offset", "pg_lsn")


# --- row history -----------------------------------------------------------------------------


def _history(spark, folder) -> DataFrame:
    return build_history(stored(data.decoded_log(spark, folder), "decoded"), STATUS)


def _two_steps(spark, folder):
    """State after the events before CUT, and the batch of the next run: a day of overlap and the rest."""
    log = data.parsed_log(spark, folder)
    seen = log.where(F.col("kafka_timestamp") < instant(CUT))
    first = stored(latest_per_key(decode_payload(seen, STATUS)), "staged")
    state = apply_scd2(empty_silver(spark, STATUS), first, STATUS, instant(CUT))
    news = incremental_slice(log, STATUS.name, read_watermark(state), lookback_ms=DAY_MS)
    batch = with_row_hash(latest_per_key(decode_payload(news, STATUS)), STATUS)
    return current_rows(state), batch, advance_fences(None, first)


@query("scd2_history")
def scd2_history(spark, folder):
    return _history(spark, folder).select(
        "id", "status", "is_active", "operation", "pg_lsn", "_valid_from", "_valid_to", "_is_current", "_hash", *CLOSE
    )


@query("scd2_history_hot")
def scd2_history_hot(spark, folder):
    """As ``scd2_history``, with every key of more than ten events cut into segments."""
    rows = build_history(stored(data.decoded_log(spark, folder), "decoded"), STATUS, max_rows_per_key=10)
    return rows.select("id", "status", "is_active", "operation", "pg_lsn", "_valid_from", "_valid_to", "_is_current", *CLOSE)


@query("history_with_late_events")
def history_with_late_events(spark, folder):
    """Events in three deliveries without regard to their order: the first builds, the others are spliced in."""
    part = F.pmod(F.crc32(F.col("kafka_offset").cast("string").cast("binary")), F.lit(3))
    parts = stored(data.decoded_log(spark, folder).withColumn("part", part), "decoded", "part")
    first, *others = [parts.where(F.col("part") == i).drop("part") for i in range(3)]
    history, spine = stored(build_history(first, STATUS), "history"), stored(history_spine(first, STATUS), "spine")
    for late in others:
        history = stored(splice_late(history, spine, late, STATUS), "history")
        spine = spine.unionByName(history_spine(late, STATUS))
    return history.select(
        "id", "status", "is_active", "operation", "pg_lsn", "_valid_from", "_valid_to", "_is_current", "_hash", *CLOSE
    )


@query("scd2_actions")
def scd2_actions(spark, folder):
    open_rows, batch, known = _two_steps(spark, folder)
    return plan_actions(open_rows, batch, STATUS, known).select("id", "action")


@query("scd2_merge")
def scd2_merge(spark, folder):
    open_rows, batch, known = _two_steps(spark, folder)
    return apply_scd2(open_rows, batch, STATUS, instant(AFTER), known)


@query("scd2_anti_replay")
def scd2_anti_replay(spark, folder):
    open_rows, batch, known = _two_steps(spark, folder)
    after = current_rows(apply_scd2(open_rows, batch, STATUS, instant(AFTER), known))
    columns = ["id", "operation", "kafka_offset", "_hash"]
    first = unseen_rows(batch, open_rows, STATUS).select(F.lit("first").alias("delivery"), *columns)
    return first.unionByName(unseen_rows(batch, after, STATUS).select(F.lit("replay").alias("delivery"), *columns))


@query("scd2_last_closed")
def scd2_last_closed(spark, folder):
    return last_closed(_history(spark, folder))


@query("scd2_current")
def scd2_current(spark, folder):
    return current_rows(_history(spark, folder)).select("id", "status", "pg_lsn", "_valid_from")


@query("silver_stats")
def silver_stats(spark, folder):
    return quality.table_stats(_history(spark, folder))


@query("scd2_as_of")
def scd2_as_of(spark, folder):
    return as_of(_history(spark, folder), instant(CUT)).select("id", "status", "_valid_from", "_valid_to")


@query("scd2_fact_join")
def scd2_fact_join(spark, folder):
    facts = table(spark, folder, "events").select("event_id", "user_id", "ts")
    history = stored(_history(spark, folder), "silver", "_is_current")
    joined = fact_join(facts, history, "user_id", "ts", ["status"])
    return joined.select("event_id", "user_id", "status", "_valid_from", "_valid_to")


@query("scd2_fact_join_hot")
def scd2_fact_join_hot(spark, folder):
    """As ``scd2_fact_join``, with every key of more than ten facts and versions cut into segments."""
    facts = table(spark, folder, "events").select("event_id", "user_id", "ts")
    history = stored(_history(spark, folder), "silver", "_is_current")
    joined = fact_join(facts, history, "user_id", "ts", ["status"], max_rows_per_key=10)
    return joined.select("event_id", "user_id", "status", "_valid_from", "_valid_to")


# --- marts -----------------------------------------------------------------------------------


@query("gold_user_analytics")
def gold_user_analytics(spark, folder):
    users, orders = data.customers(spark, folder), data.purchases(spark, folder)
    return user_analytics(users, orders, instant(TODAY), refreshed_at=instant(AFTER))


@query("gold_user_analytics_orders")
def gold_user_analytics_orders(spark, folder):
    users, orders = data.customers(spark, folder), data.order_totals(spark, folder)
    return user_analytics(users, orders, instant(TODAY_H), SEGMENTS_H, refreshed_at=instant(AFTER))


@query("gold_product_analytics")
def gold_product_analytics(spark, folder):
    products, orders = data.parts(spark, folder), data.purchases(spark, folder)
    return product_analytics(products, orders, instant(TODAY), refreshed_at=instant(AFTER))


@query("gold_product_analytics_lines")
def gold_product_analytics_lines(spark, folder):
    products, orders = data.parts(spark, folder), data.order_lines(spark, folder)
    return product_analytics(products, orders, instant(TODAY_H), TIERS_H, refreshed_at=instant(AFTER))


@query("gold_daily_sales")
def gold_daily_sales(spark, folder):
    return daily_sales(data.purchases(spark, folder), refreshed_at=instant(AFTER))


@query("gold_daily_sales_lines")
def gold_daily_sales_lines(spark, folder):
    return daily_sales(data.order_lines(spark, folder), refreshed_at=instant(AFTER))


@query("gold_top_product")
def gold_top_product(spark, folder):
    return top_products(data.purchases(spark, folder))


@query("gold_product_days")
def gold_product_days(spark, folder):
    return product_days(data.order_lines(spark, folder)).select("order_date", "product_id", "order_count", "revenue_cents")


def _changing_lines(spark, folder) -> list[tuple[DataFrame, DataFrame, DataFrame]]:
    """Order lines in three steps, each as (opened, closed, current).

    First all lines of even orders; then the others, and every tenth order moved to a year earlier and doubled;
    then every seventh order is gone, in whatever state it is.
    """
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    lines = stored(
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("l_orderkey").alias("key"),
            F.col("o_custkey").alias("user_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_extendedprice").alias("total_amount"),
            F.col("o_orderdate").cast("timestamp").alias("_valid_from"),
        ),
        "lines",
    )
    moved = lines.where("key % 10 = 0").withColumns(
        {"total_amount": F.col("total_amount") * 2, "_valid_from": F.add_months("_valid_from", -12).cast("timestamp")}
    )
    even, odd = lines.where("key % 2 = 0"), lines.where("key % 2 = 1")
    second = lines.where("key % 10 <> 0").unionByName(moved)
    gone = second.where("key % 7 = 0")
    return [
        (even, lines.limit(0), even),
        (odd.unionByName(moved), lines.where("key % 10 = 0"), second),
        (lines.limit(0), gone, second.where("key % 7 <> 0")),
    ]


@query("gold_incremental")
def gold_incremental(spark, folder):
    """The three marts from totals kept up over three steps with changed and deleted orders; one text per row."""
    totals = OrderTotals(fresh_folder(spark, "order-totals"))
    totals.create(spark)
    for opened, closed, current in _changing_lines(spark, folder):
        totals.advance(opened, closed, current)
    users, products, stamp = data.customers(spark, folder), data.parts(spark, folder), instant(AFTER)
    return _marts_as_text(
        {
            "user_analytics": totals.user_analytics(users, instant(TODAY_H), SEGMENTS_H, stamp),
            "product_analytics": totals.product_analytics(products, instant(TODAY_H), TIERS_H, stamp),
            "sales_summary": totals.daily_sales(spark, stamp),
        }
    )


def _shop_records(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Change records of users, products and orders in two deliveries: (key, value, position).

    The second brings the later purchases, doubles every tenth earlier one and deletes every seventh.
    """

    def records(rows, name, op, lsn, deleted=False):
        image = F.struct(*rows.columns)
        before, after = (F.struct("id"), None) if deleted else (None, image)
        return rows.select(envelope_json(before, after, F.lit(op), F.lit(0), F.lit(name), lsn).alias("value"))

    users = data.customers(spark, folder).select("id", "name", "email")
    products = data.parts(spark, folder)
    bought = data.purchases(spark, folder)
    orders = bought.select("id", "user_id", "product_id", "quantity", "total_amount", "status")
    early = orders.join(bought.where(F.col("_valid_from") < instant(CUT)).select("id"), "id", "left_semi")
    late = orders.join(bought.where(F.col("_valid_from") >= instant(CUT)).select("id"), "id", "left_semi")
    doubled = early.where("id % 10 = 0").withColumn("total_amount", F.col("total_amount") * 2)
    first = [records(users, "users", "c", F.lit(1)), records(products, "products", "c", F.lit(1)), records(early, "orders", "c", F.lit(1))]
    second = [
        records(late, "orders", "c", F.lit(2)),
        records(doubled, "orders", "u", F.lit(2)),
        records(early.where("id % 7 = 0"), "orders", "d", F.lit(3), deleted=True),
    ]
    return tuple(parts[0].unionByName(parts[1]).unionByName(parts[2]) for parts in (first, second))


@query("pipeline_marts")
def pipeline_marts(spark, folder):
    """Records, log, two refinement runs of the three entities, published marts, read from their views."""
    database, log = _fresh_silver(spark).database, None
    for number, (records, stamp) in enumerate(zip(_shop_records(spark, folder), (CUT, AFTER))):
        shaped = records.select(
            F.lit("shop").alias("topic"),
            F.lit(0).alias("partition"),
            F.monotonically_increasing_id().alias("offset"),
            instant(stamp).alias("timestamp"),
            F.lit(None).cast("string").alias("key"),
            "value",
        )
        batch = stored(parse_envelope(shaped, data.ingest_clock()).withColumn("_batch_id", F.lit(number).cast("bigint")), "log")
        log = batch if log is None else log.unionByName(batch)
        for spec in ENTITIES.values():
            SilverTable(database, spec, 8).refine(log, instant(stamp))
    publish_all(spark, database)
    return _marts_as_text({name: spark.table(f"{database}.gold_{name}") for name in ("user_analytics", "product_analytics", "sales_summary")})


def _marts_as_text(marts: dict[str, DataFrame]) -> DataFrame:
    """The marts' main columns under common names."""
    columns = {
        "user_analytics": ("users", "user_id", "total_spent", "segment", F.date_format("last_order_date", "yyyy-MM-dd")),
        "product_analytics": (
            "products",
            "product_id",
            "total_revenue",
            "performance_tier",
            F.round(F.col("revenue_last_30d") * 100).cast("bigint").cast("string"),
        ),
        "sales_summary": ("days", "date_key", "total_revenue", "top_product_id", F.col("unique_customers").cast("string")),
    }
    rows = [
        marts[mart].select(
            F.lit(name).alias("mart"),
            F.col(key).cast("string").alias("subject"),
            F.col("total_orders").cast("bigint").alias("total_orders"),
            F.round(F.col(revenue) * 100).cast("bigint").alias("cents"),
            F.col(label).cast("string").alias("label"),
            extra.alias("extra"),
        )
        for mart, (name, key, revenue, label, extra) in columns.items()
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query("gold_distinct_rollup")
def gold_distinct_rollup(spark, folder):
    """Distinct customers of days, weeks and months, all from one stored table of bitmaps."""
    days = stored(customer_days(data.order_totals(spark, folder)), "customer-days")
    periods = [distinct_customers(days, period) for period in ("day", "week", "month")]
    return periods[0].unionByName(periods[1]).unionByName(periods[2])


@query("gold_roundtrip")
def gold_roundtrip(spark, folder):
    path = fresh_folder(spark, "mart")
    gold_daily_sales(spark, folder).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@query("gold_counts")
def gold_counts(spark, folder):
    marts = {
        "gold_user_analytics": gold_user_analytics(spark, folder),
        "gold_product_analytics": gold_product_analytics(spark, folder),
        "gold_sales_summary": gold_daily_sales(spark, folder),
    }
    counts = [
        rows.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("mart"), "row_count")
        for name, rows in marts.items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


# --- snapshots -------------------------------------------------------------------------------


@query("snapshot_events")
def snapshot_events(spark, folder):
    return snapshot_to_events(table(spark, folder, "customer"), "users", "c_custkey", ts_ms=1_704_067_200_000)


@query("snapshot_diff")
def snapshot_diff(spark, folder):
    return diff_snapshots(table(spark, folder, "customer"), data.changed_customers(spark, folder), "c_custkey")


@query("snapshot_diff_pruned")
def snapshot_diff_pruned(spark, folder):
    """As ``snapshot_diff``, from stored snapshots whose range hashes tell which ranges to read."""
    snapshots = (table(spark, folder, "customer"), data.changed_customers(spark, folder))
    trees = [write_snapshot(rows, "c_custkey", fresh_folder(spark, "snapshot"), width=500, fan=8) for rows in snapshots]
    return diff_trees(*trees, "c_custkey", spark)


# --- streaming -------------------------------------------------------------------------------


def _record_stream(spark, folder, damaged=False) -> DataFrame:
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    schema = table(spark, folder, "events").schema
    # A pattern, because the file stream takes a plain path only if it is a folder.
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1000).parquet(f"{folder}/event[s].parquet")
    return data.change_records(events, damaged)


@query("stream_bronze")
def stream_bronze(spark, folder):
    path = fresh_folder(spark, "log")
    good, _ = split_events(parse_envelope(_record_stream(spark, folder, damaged=True)))
    start_log_writer(good, path, f"{path}-checkpoint", interval=None, copy_tasks=COPY_TASKS).awaitTermination()
    written = spark.read.parquet(path)
    return written.select("event_id", "operation", "source_table", "after_json", "before_json", "source_ts_ms")


@query("log_table_scan")
def log_table_scan(spark, folder):
    """The raw log as a catalog table over what split ingest wrote, read by entity."""
    path = fresh_folder(spark, "log-table")
    records = _record_stream(spark, folder, damaged=True)
    start_split_ingest(records, f"{path}/log", f"{path}/dead", f"{path}/checkpoint", interval=None).awaitTermination()
    database = _fresh_silver(spark).database
    ensure_log_table(spark, f"{database}.log", f"{path}/log")
    recover(spark, f"{database}.log")
    rows = spark.table(f"{database}.log").where(F.col("source_table") == "users")
    return rows.select("event_id", "operation", "source_table", "after_json", "before_json", "source_ts_ms")


@query("log_compacted")
def log_compacted(spark, folder):
    """The accepted events from the clustered copy of the log."""
    good, _ = split_events(data.parsed_log(spark, folder, damaged=True))
    name = f"{_fresh_silver(spark).database}.log_compacted"
    compact_log(stored(good, "log"), name, files=4)
    return spark.table(name).select("event_id", "operation", "source_table", "after_json", "before_json", "source_ts_ms")


@query("stream_dlq")
def stream_dlq(spark, folder):
    path = fresh_folder(spark, "dead")
    _, dead = split_events(parse_envelope(_record_stream(spark, folder, damaged=True)))
    start_dead_letter_writer(dead, path, f"{path}-checkpoint", interval=None).awaitTermination()
    layout = "topic string, kafka_partition int, kafka_offset bigint, raw_value string, error_type string"
    return spark.read.schema(layout).json(path)


@query("stream_dedup")
def stream_dedup(spark, folder):
    path = fresh_folder(spark, "log")
    delivered = _record_stream(spark, folder).unionByName(_record_stream(spark, folder))
    good, _ = split_events(parse_envelope(delivered))
    start_log_writer(good, path, f"{path}-checkpoint", interval=None, copy_tasks=COPY_TASKS).awaitTermination()
    return spark.read.parquet(path).select("event_id", "kafka_offset", "raw_value")


@query("stream_dedup_late_copy")
def stream_dedup_late_copy(spark, folder):
    """All good events delivered, and ten days later all of them again, to a stream started anew."""
    path = fresh_folder(spark, "late-copies")
    good, _ = split_events(data.parsed_log(spark, folder, damaged=True))

    def deliver(events):
        events.write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(good.schema).parquet(f"{path}/in")
        paths = (f"{path}/log", f"{path}/seen", f"{path}/checkpoint")
        start_distinct_log_writer(stream, *paths, interval=None).awaitTermination()

    deliver(good)
    deliver(good.withColumn("processed_at", F.col("processed_at") + F.expr("INTERVAL 10 days")))
    written = spark.read.parquet(f"{path}/log")
    return written.select("event_id", "operation", "source_table", "after_json", "before_json", "source_ts_ms")


@query("stream_split")
def stream_split(spark, folder):
    path = fresh_folder(spark, "split")
    log, dead = f"{path}/log", f"{path}/dead"
    records = _record_stream(spark, folder, damaged=True)
    checkpoint = f"{path}/checkpoint"
    start_split_ingest(records, log, dead, checkpoint, interval=None, copy_tasks=COPY_TASKS).awaitTermination()
    good = spark.read.parquet(log).select("kafka_offset", F.lit("GOOD").alias("outcome"))
    bad = spark.read.schema("kafka_offset bigint, error_type string").json(dead)
    return good.unionByName(bad.select("kafka_offset", F.col("error_type").alias("outcome")))


# --- quality ---------------------------------------------------------------------------------


@query("dq_nulls")
def dq_nulls(spark, folder):
    return quality.null_counts(data.decoded_log(spark, folder, ACCOUNT), ["id", "status", "amount", "k"])


@query("dq_payload_fields")
def dq_payload_fields(spark, folder):
    return quality.payload_fields(data.parsed_log(spark, folder), VISIT)


@query("schema_evolution")
def schema_evolution(spark, folder):
    """Fields of the later events against a registry of the earlier ones, whose images were of another layout."""
    log = data.parsed_log(spark, folder)
    early = F.col("kafka_timestamp") < instant(CUT)
    image = F.from_json("after_json", "id bigint, status string, amount double")
    earlier = log.where(early).withColumn("_image", image).where(F.col("_image").isNotNull())
    fields = [F.col("_image.id"), F.col("_image.status"), F.floor("_image.amount").alias("amount")]
    layout = F.to_json(F.struct(*fields, (F.col("kafka_offset") % 2 == 0).alias("flag")))
    known = observed_fields(earlier.withColumn("after_json", layout)).select("source_table", "field", "kind")
    return schema_changes(known, observed_fields(log.where(~early)))


@query("dq_duplicates")
def dq_duplicates(spark, folder):
    return quality.duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq_orphans")
def dq_orphans(spark, folder):
    checks = {
        "orders.o_custkey": ("orders", "o_custkey", "customer", "c_custkey"),
        "lineitem.l_partkey": ("lineitem", "l_partkey", "part", "p_partkey"),
        "events.user_id": ("events", "user_id", "supplier", "s_suppkey"),
    }
    reports = []
    for label, (child, column, parent, key) in checks.items():
        found = quality.orphans(table(spark, folder, child), table(spark, folder, parent), {column: key})
        reports.append(found.select(F.lit(label).alias("reference"), F.col(column).alias("missing_key"), "row_count"))
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


@query("dq_message_rate")
def dq_message_rate(spark, folder):
    return quality.message_rate(data.parsed_log(spark, folder))


@query("dq_lag")
def dq_lag(spark, folder):
    return quality.ingest_lag(data.parsed_log(spark, folder))


@query("stream_lag")
def stream_lag(spark, folder):
    """Lag percentiles per entity and day, from hourly histograms that a stream keeps."""
    path = fresh_folder(spark, "lag")
    events = parse_envelope(_record_stream(spark, folder), data.ingest_clock())
    # The files aren't in the order of event time: none of the month may be too late.
    start_lag_writer(events, f"{path}/lag", f"{path}/checkpoint", delay="60 days", interval=None).awaitTermination()
    days = read_lag_histogram(spark, f"{path}/lag").withColumn("day", F.date_trunc("day", "window_start"))
    return quality.lag_percentiles(days, "source_table", "day")


@query("stream_fact_join")
def stream_fact_join(spark, folder):
    """Events as facts, in two deliveries by time; those of the last five days aren't settled yet."""
    path = fresh_folder(spark, "facts")
    history = stored(_history(spark, folder), "silver", "_is_current")
    facts = table(spark, folder, "events").select("event_id", "user_id", "ts")
    names = ("user_id", "ts", ["status"])

    def deliver(some):
        some.write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(facts.schema).parquet(f"{path}/in")
        paths = (f"{path}/out", f"{path}/checkpoint")
        start_fact_writer(stream, lambda: history, *names, *paths, delay="5 days", interval=None).awaitTermination()

    early = F.col("ts").cast("timestamp") < instant(CUT)
    deliver(facts.where(early))
    deliver(facts.where(~F.coalesce(early, F.lit(False))))
    found = read_facts(spark, f"{path}/out", facts, history, *names)
    return found.select("event_id", "user_id", "status", "_valid_from", "settled")


@query("dq_scd2_invariants")
def dq_scd2_invariants(spark, folder):
    """A sound history breaks no rule; with its open rows written twice it breaks two per open key."""
    history = stored(_history(spark, folder), "silver", "_is_current")
    sound = quality.history_violations(history).withColumn("written", F.lit("once"))
    doubled = quality.history_violations(history.unionByName(current_rows(history)))
    return sound.unionByName(doubled.withColumn("written", F.lit("open rows twice")))


@query("dq_scd2_invariants_hot")
def dq_scd2_invariants_hot(spark, folder):
    """As ``dq_scd2_invariants``, with every key of more than ten versions cut into segments."""
    history = stored(_history(spark, folder), "silver", "_is_current")
    sound = quality.history_violations(history, 10).withColumn("written", F.lit("once"))
    doubled = quality.history_violations(history.unionByName(current_rows(history)), 10)
    return sound.unionByName(doubled.withColumn("written", F.lit("open rows twice")))


@query("health_rollup")
def health_rollup(spark, folder):
    return quality.connector_health(data.status_documents(spark, folder))


@query("health_summary")
def health_summary(spark, folder):
    return quality.health_summary(quality.connector_health(data.status_documents(spark, folder)))
