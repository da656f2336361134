"""Streams that keep their state in tables: the ledger of event ids, and facts that wait for their version."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from chronolake.functions.specs import EntitySpec
from chronolake.operators.envelope import parse_envelope, split_events
from chronolake.operators.history import build_history, fact_join
from chronolake.streaming import seen
from chronolake.streaming.facts import read_facts, start_fact_writer
from chronolake.streaming.seen import start_distinct_log_writer
from events import decoded, random_log

STATUS = EntitySpec("users", {"id": "bigint", "status": "string"})
DAY = timedelta(days=1)


def delivered(spark, offsets, late_days=0):
    """Good events of one record a day; copies keep the broker's time and differ in the time of ingest."""
    value = '{"before":null,"after":"{}","op":"c","ts_ms":1,"source":{"db":"d","schema":"s","table":"t","lsn":1,"txId":1}}'
    rows = spark.createDataFrame([(n,) for n in offsets], "offset bigint").select(
        F.lit("t").alias("topic"),
        F.lit(0).alias("partition"),
        "offset",
        F.when(F.col("offset") != 13, F.timestamp_seconds(F.lit(1_704_067_200) + 86_400 * F.col("offset"))).alias("timestamp"),
        F.lit("k").alias("key"),
        F.lit(value).alias("value"),
    )
    clock = F.col("kafka_timestamp") + F.make_dt_interval(F.lit(late_days))
    return split_events(parse_envelope(rows, clock))[0]


@pytest.mark.parametrize("max_days", [366, 2])
def test_copies_are_known_after_months_and_by_new_streams(spark, tmp_path, monkeypatch, max_days):
    monkeypatch.setattr(seen, "MAX_DAYS", max_days)
    paths = [str(tmp_path / name) for name in ("log", "seen", "checkpoint")]

    def step(events):
        events.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
        start_distinct_log_writer(stream, *paths, interval=None).awaitTermination()

    step(delivered(spark, [0, 0, 1, 2, 13, 13]))
    step(delivered(spark, [0, 1, 3, 13], late_days=90))
    step(delivered(spark, [3, 2, 4, 4], late_days=200))
    found = {r.kafka_offset: r for r in spark.read.parquet(paths[0]).collect()}
    assert sorted(found) == [0, 1, 2, 3, 4, 13] and spark.read.parquet(paths[0]).count() == 6
    assert [(found[n].processed_at - found[n].kafka_timestamp) // DAY for n in (0, 1, 2, 3, 4)] == [0, 0, 0, 90, 200]
    with pytest.raises(ValueError, match="another checkpoint"):
        start_distinct_log_writer(spark.readStream.schema(delivered(spark, [1]).schema).parquet(str(tmp_path / "in")),
                                  paths[0], paths[1], str(tmp_path / "other"), interval=None)


def test_a_batch_that_is_run_again_decides_the_same(spark, tmp_path):
    own = delivered(spark, [1, 2, 3]).withColumn("broker_day", F.to_date("kafka_timestamp"))
    ids = own.where("kafka_offset < 3").withColumn("_batch_id", F.when(F.col("kafka_offset") == 1, 6).otherwise(7))
    ids.select("event_id", "broker_day", "_batch_id").write.partitionBy("broker_day", "_batch_id").parquet(str(tmp_path / "seen"))
    ledger = seen._ledger(spark, str(tmp_path / "seen"), own)
    fresh = seen._unseen(own, ledger, 7)  # offset 2 is of batch 7 itself, which died before its end
    assert sorted(r.kafka_offset for r in fresh.collect()) == [2, 3]


@pytest.mark.parametrize("seed", [1, 2])
def test_settled_facts_equal_the_join_with_all_history(spark, tmp_path, seed):
    draw = random.Random(seed)
    log = random_log(seed, keys=12, events=240, hot_share=0.3)
    start, end = log[0]["ts_ms"], log[-1]["ts_ms"]
    delay = 10 * 60_000
    layout = "fact bigint, id bigint, at timestamp"
    facts = [(n, draw.choice([None, *range(13)]), draw.randrange(start - 1000, end + 1000)) for n in range(300)]
    frame = spark.createDataFrame([(n, k, t) for n, k, t in facts], "fact bigint, id bigint, ms bigint")
    frame = frame.select("fact", "id", F.when(F.col("fact") % 50 != 0, F.timestamp_millis("ms")).alias("at"))
    names = ("id", "at", ["status"])
    now = {}

    def step(some):
        some.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(layout).parquet(str(tmp_path / "in"))
        paths = (str(tmp_path / "out"), str(tmp_path / "checkpoint"))
        writer = start_fact_writer(stream, lambda: now["history"], *names, *paths, delay="10 minutes", interval=None)
        writer.awaitTermination()

    nothing = read_facts(spark, str(tmp_path / "out"), frame, build_history(decoded(spark, log), STATUS), *names)
    assert nothing.count() == 0 and "settled" in nothing.columns
    held, seen_settled = {}, {}
    for part in range(3):
        until = start + (end - start) * (part + 1) // 3
        known = []
        for event in log:
            late = held.setdefault((part, event["offset"]), draw.random() < 0.5)
            if event["ts_ms"] <= until and not (part < 2 and event["ts_ms"] > until - delay and late):
                known.append(event)
        now["history"] = build_history(decoded(spark, known), STATUS)
        step(frame.where(F.col("fact") % 3 == part))
        rows = read_facts(spark, str(tmp_path / "out"), frame, now["history"], *names).collect()
        assert len(rows) == len({r.fact for r in rows}) == 100 * (part + 1)
        settled = {r.fact: r for r in rows if r.settled}
        assert all(settled[fact] == row for fact, row in seen_settled.items())
        seen_settled = settled
    whole = {r.fact: r for r in fact_join(frame, now["history"], *names).drop("_valid_to").collect()}
    assert 100 < len(seen_settled) < 300
    assert all(whole[r.fact] == tuple(r)[:-1] for r in rows)
