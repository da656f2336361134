"""Lag histograms: buckets, merging, and the stream that keeps them."""

import random

from pyspark.sql import functions as F

from chronolake.operators.quality import lag_histogram, lag_percentiles
from chronolake.streaming.lag import read_lag_histogram, start_lag_writer

START = 1_704_067_200_000
HOUR = 3_600_000


def events(spark, rows):
    frame = spark.createDataFrame(rows, "source_table string, source_ts_ms bigint, lag bigint")
    return frame.withColumn("processed_at", F.timestamp_millis(F.col("source_ts_ms") + F.col("lag"))).drop("lag")


def random_rows(seed, n=2000):
    draw = random.Random(seed)
    tables = ("users", "orders")
    return [(draw.choice(tables), START + draw.randrange(5 * HOUR), int(10 ** (draw.random() * 6)) - 1) for _ in range(n)]


def test_buckets_hold_their_lags(spark):
    lags = [-70, 0, 1, 31, 32, 33, 63, 64, 1000, 123_456_789]
    found = lag_histogram(events(spark, [("t", START + i * HOUR, lag) for i, lag in enumerate(lags)])).orderBy("window_start").collect()
    for lag, row in zip(lags, found, strict=True):
        assert row.lag_from_ms <= max(lag, 0) < row.lag_to_ms and row.event_count == 1
        assert row.lag_to_ms - row.lag_from_ms <= max(1, row.lag_from_ms / 16)


def test_percentiles_of_merged_hours(spark):
    rows = random_rows(1)
    merged = lag_percentiles(lag_histogram(events(spark, rows)), "source_table").collect()
    for row in merged:
        own = sorted(lag for name, _, lag in rows if name == row.source_table)
        assert row.event_count == len(own)
        for percent, end in ((50, row.p50_lag_ms), (95, row.p95_lag_ms), (99, row.p99_lag_ms)):
            exact = own[-(-len(own) * percent // 100) - 1]
            assert exact < end <= exact * 17 / 16 + 1


def test_stream_equals_batch_and_drops_what_is_too_late(spark, tmp_path):
    first, second = random_rows(2), random_rows(3)
    late = [("users", START - 50 * HOUR, 5)]
    source, out, checkpoint = (str(tmp_path / name) for name in ("source", "out", "checkpoint"))

    def step(rows):
        events(spark, rows).coalesce(1).write.mode("append").parquet(source)
        read = spark.readStream.schema(events(spark, rows).schema).parquet(source)
        start_lag_writer(read, out, checkpoint, delay="10 hours", interval=None).awaitTermination()

    step(first)
    step(second)
    step(late)
    columns = ["source_table", "window_start", "lag_from_ms", "lag_to_ms", "event_count"]
    expected = lag_histogram(events(spark, first + second)).select(columns).collect()
    assert sorted(read_lag_histogram(spark, out).select(columns).collect()) == sorted(expected)


def test_empty(spark):
    nothing = lag_histogram(events(spark, []))
    assert nothing.count() == 0 and lag_percentiles(nothing, "source_table").count() == 0
