"""Parsing, classification, dedup, incremental reads."""

import json

import pytest
from pyspark.sql import functions as F

from chronolake.operators.envelope import classify, dead_letters, dedupe_events, parse_envelope, split_events
from chronolake.operators.incremental import incremental_slice, read_watermark
from shop import Feed


def records(spark, raw):
    frame = spark.createDataFrame([json.dumps(r) for r in raw], "string").select(
        F.from_json("value", "topic string, partition int, offset bigint, timestamp timestamp, key string, value string").alias("r")
    )
    return frame.select("r.*")


def edge_records():
    feed = Feed()
    good = [
        feed.record("users", "c", {"id": 1}),
        feed.record("users", "d", None, {"id": 1}),
        feed.record("products", "u", {"id": 1, "price": "abc"}),
    ]
    bad = [
        (feed.raw(None), "NULL_OPERATION"),
        (feed.raw("not json"), "NULL_OPERATION"),
        (feed.record("users", None, {"id": 1}), "NULL_OPERATION"),
        (feed.record("users", "r", {"id": 1}), "INVALID_OPERATION"),
        (feed.record(None, "x", {"id": 1}), "INVALID_OPERATION"),
        (feed.record(None, "u", {"id": 1}), "NULL_TABLE"),
        (feed.record("users", "u"), "EMPTY_PAYLOAD"),
    ]
    return good, bad


def test_every_class_and_no_event_lost(spark):
    good, bad = edge_records()
    events = parse_envelope(records(spark, good + [r for r, _ in bad]))
    kept, dead = split_events(events)
    assert sorted(r["kafka_offset"] for r in kept.collect()) == [r["offset"] for r in good]
    assert {r["kafka_offset"]: r["error_type"] for r in dead.collect()} == {r["offset"]: c for r, c in bad}
    assert dead.columns == [
        "topic", "kafka_partition", "kafka_offset", "raw_value", "error_type", "processed_at", "dlq_timestamp",
    ]
    assert "error_type" not in kept.columns and len(kept.columns) == 18


def test_row_images_keep_their_text(spark):
    feed = Feed()
    raw = feed.raw('{"op":"c","after":{"id": 1,  "amount": 10.50, "big": 12345678901234567890},"ts_ms":5,"source":{"table":"t","lsn":3}}')
    row = parse_envelope(records(spark, [raw])).first()
    assert json.loads(row["after_json"]) == {"id": 1, "amount": 10.5, "big": 12345678901234567890}
    assert row["before_json"] is None
    assert (row["pg_lsn"], row["_cdc_order_lsn"], row["source_ts_ms"], row["pg_tx_id"]) == (3, 3, 5, None)
    assert row["event_id"] == f"cdc.public.users-0-{raw['offset']}"


def test_bytes_are_decoded(spark):
    frame = spark.createDataFrame([("t", 3, 4, bytearray(b"k"), bytearray(b'{"op":"c"}'))], "topic string, partition int, offset bigint, key binary, value binary")
    row = parse_envelope(frame.withColumn("timestamp", F.current_timestamp())).first()
    assert (row["record_key"], row["raw_value"], row["operation"]) == ("k", '{"op":"c"}', "c")


def test_snapshot_reads_can_count_as_creates(spark):
    event = Feed().record("users", "r", {"id": 1})
    assert split_events(parse_envelope(records(spark, [event])))[0].isEmpty()
    assert split_events(parse_envelope(records(spark, [event]), snapshot_ops=("r",)))[0].first()["operation"] == "c"


def test_filters_do_not_parse_again(spark):
    good, bad = edge_records()
    events = classify(parse_envelope(records(spark, good + [r for r, _ in bad])))
    plan = dead_letters(events)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(StructField(before") == 1


def test_dedupe_keeps_one_of_each_position(spark):
    feed = Feed()
    one, two = feed.record("users", "c", {"id": 1}), feed.record("users", "u", {"id": 1})
    events = parse_envelope(records(spark, [one, two, one, one]))
    assert sorted(r["kafka_offset"] for r in dedupe_events(events).collect()) == [1, 2]


def test_incremental_slice(spark, tmp_path):
    frame = spark.range(10).select(
        F.when(F.col("id") % 2 == 0, "users").otherwise("orders").alias("source_table"),
        F.timestamp_millis(F.col("id") * 3_600_000).cast("date").alias("ingest_date"),
        (F.col("id") * 3_600_000).alias("source_ts_ms"),
    )
    frame.write.partitionBy("source_table", "ingest_date").parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    mark = read_watermark(log.where("source_table = 'users'"))
    assert mark == 8 * 3_600_000
    assert incremental_slice(log, "users", None).count() == 5
    assert [r["source_ts_ms"] for r in incremental_slice(log, "users", mark).collect()] == [mark]
    day = incremental_slice(log, "users", mark, lookback_ms=5 * 3_600_000)
    assert sorted(r["source_ts_ms"] for r in day.collect()) == [4 * 3_600_000, 6 * 3_600_000, 8 * 3_600_000]
    assert read_watermark(log.where("source_table = 'none'")) is None
    plan = incremental_slice(log, "users", mark)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(source_ts_ms" in plan
    partition_filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "source_table" in partition_filters and "ingest_date" in partition_filters


@pytest.mark.parametrize("delay_ms", [0, 10])
def test_late_event_inside_the_lookback_is_read_again(spark, delay_ms):
    log = spark.createDataFrame([("users", 10_000_000), ("users", 10_000_000 - 3_600_000 + delay_ms)], "source_table string, source_ts_ms bigint")
    assert incremental_slice(log, "users", 10_000_000).count() == (2 if delay_ms else 1)
