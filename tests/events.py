"""Random decoded events."""

import random

from pyspark.sql import functions as F

COLUMNS = "id bigint, status string, op string, ts_ms bigint, lsn bigint, offset bigint"


def random_log(seed, keys=40, events=600, hot_share=0.0, statuses=3):
    """Events in log order; ``hot_share`` of them belong to key 0. Some share one commit time."""
    rng = random.Random(seed)
    log, ts_ms = [], 1_704_067_200_000
    for position in range(1, events + 1):
        ts_ms += rng.choice([0, 0, 1, 250, 60_000])
        op = rng.choice("cuuud")
        key = 0 if rng.random() < hot_share else rng.randrange(keys)
        status = None if op == "d" else f"s{rng.randrange(statuses)}"
        log.append({"id": key, "status": status, "op": op, "ts_ms": ts_ms, "lsn": position // 2, "offset": position})
    return log


def decoded(spark, log):
    rows = spark.createDataFrame([tuple(e[c.split()[0]] for c in COLUMNS.split(", ")) for e in log], COLUMNS)
    return rows.select(
        "id",
        "status",
        (F.col("op") != "d").alias("is_active"),
        F.col("op").alias("operation"),
        F.col("ts_ms").alias("source_ts_ms"),
        F.timestamp_millis("ts_ms").alias("processed_at"),
        F.lit(0).alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("lsn").alias("pg_lsn"),
    )
