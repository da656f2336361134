"""Quality reports on literal rows."""

import json

from pyspark.sql import functions as F

from chronolake.operators import quality
from chronolake.functions.specs import USERS


def test_null_counts_and_duplicates(spark):
    rows = spark.createDataFrame([(1, None), (1, "a"), (None, None), (2, "b")], "id int, v string")
    assert sorted(map(tuple, quality.null_counts(rows, ["id", "v"]).collect())) == [("id", 4, 1), ("v", 4, 2)]
    assert list(map(tuple, quality.duplicate_keys(rows, ["id"]).collect())) == [(1, 2)]


def test_orphans_ignore_missing_references(spark):
    rows = spark.createDataFrame([(1,), (9,), (9,), (None,)], "user_id int")
    parents = spark.createDataFrame([(1,), (2,)], "id int")
    assert list(map(tuple, quality.orphans(rows, parents, {"user_id": "id"}).collect())) == [(9, 2)]


def test_acceptance(spark):
    rows = spark.createDataFrame([("t", None), ("t", "X"), ("t", None), ("u", None)], "topic string, error_type string")
    report = {r["topic"]: tuple(r)[1:] for r in quality.acceptance(rows).collect()}
    assert report == {"t": (2, 1, 1 / 3), "u": (1, 0, 0.0)}


def test_rate_and_lag(spark):
    rows = spark.createDataFrame([("users", 0, 10), ("users", 3_599_999, 3_600_029), ("users", 3_600_000, 3_600_000)], "source_table string, source_ts_ms bigint, p bigint")
    rows = rows.withColumn("processed_at", F.timestamp_millis("p"))
    rate = quality.message_rate(rows).select(F.unix_seconds("window_start"), "event_count").collect()
    assert sorted(map(tuple, rate)) == [(0, 2), (3600, 1)]
    lag = quality.ingest_lag(rows).first()
    assert (lag["min_lag_ms"], lag["max_lag_ms"], round(lag["avg_lag_ms"], 3)) == (0, 30, 13.333)


def test_payload_fields_show_drift(spark):
    rows = spark.createDataFrame([("u", None, '{"id":1,"phone":"x"}'), ("d", '{"id":1}', None)], "operation string, before_json string, after_json string")
    found = {r["field"]: (r["row_count"], r["declared"]) for r in quality.payload_fields(rows, USERS).collect()}
    assert found == {"id": (2, True), "phone": (1, False)}


def test_connector_health(spark):
    documents = [
        ("ok", {"connector": {"state": "RUNNING"}, "tasks": [{"state": "RUNNING"}, {"state": "RUNNING"}]}),
        ("half", {"connector": {"state": "RUNNING"}, "tasks": [{"state": "FAILED"}, {}]}),
        ("down", {"connector": {"state": "PAUSED"}, "tasks": []}),
        ("odd", {}),
    ]
    frame = spark.createDataFrame([(n, json.dumps(d)) for n, d in documents], "connector string, status string")
    health = quality.connector_health(frame)
    assert {r["connector"]: tuple(r)[1:] for r in health.collect()} == {
        "ok": ("RUNNING", 2, 0, True),
        "half": ("RUNNING", 0, 1, False),
        "down": ("PAUSED", 0, 0, False),
        "odd": ("UNKNOWN", 0, 0, False),
    }
    assert tuple(quality.health_summary(health).first()) == (4, False, 1)
    assert tuple(quality.health_summary(health.where("connector = 'ok'")).first()) == (1, True, 0)
    assert tuple(quality.health_summary(health.limit(0)).first()) == (0, True, 0)


def test_table_stats(spark):
    rows = spark.createDataFrame([(True,), (False,), (True,)], "_is_current boolean")
    assert tuple(quality.table_stats(rows).first()) == (3, 2)
