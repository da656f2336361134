"""Complete history, point-in-time reads and fact joins, with plain keys and with split hot keys."""

import pytest
from pyspark.sql import functions as F

from chronolake.checks.inputs import STATUS
from chronolake.operators.history import as_of, build_history, current_rows, fact_join, history_spine, last_closed, splice_late
from chronolake.operators.quality import history_violations
from chronolake.operators.skew import SEGMENT, balance, with_neighbours
from events import decoded, random_log
from model import full_history

LIMITS = [10_000, 25]  # the second one makes hot keys of most keys


def millis(column):
    return F.unix_millis(column)


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("seed, hot", [(1, 0.0), (2, 0.4)])
def test_history_matches_the_model(spark, limit, seed, hot):
    log = random_log(seed, hot_share=hot)
    history = build_history(decoded(spark, log), STATUS, max_rows_per_key=limit)
    got = history.select("id", "status", millis("_valid_from"), millis("_valid_to"), "is_active", "_close_lsn").collect()
    assert sorted((tuple(r) for r in got), key=str) == full_history(log)


@pytest.fixture(scope="module")
def hot_history(spark):
    log = random_log(7, keys=5, events=1500, hot_share=0.4)
    folder = spark.conf.get("spark.checkpoint.dir") + "/hot-history"
    build_history(decoded(spark, log), STATUS).write.mode("overwrite").parquet(folder)
    return log, spark.read.parquet(folder)


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("how", ["left", "inner"])
def test_fact_join_matches_brute_force(spark, hot_history, limit, how):
    log, history = hot_history
    facts = [(i, e["id"] if i % 9 else 77, e["ts_ms"] + (i % 3 - 1) * 100) for i, e in enumerate(log)]
    # Many facts of one key in a row, with no version in between, and some before the first version.
    facts += [(10_000 + i, 0, log[-1]["ts_ms"] + 5 + i) for i in range(300)] + [(20_000, 1, 0)]
    frame = spark.createDataFrame(facts, "fact bigint, user bigint, ms bigint").withColumn("at", F.timestamp_millis("ms"))
    joined = fact_join(frame, history, "user", "at", ["status"], how=how, max_rows_per_key=limit)
    got = {r["fact"]: (r["status"], r["start"]) for r in joined.select("fact", "status", millis("_valid_from").alias("start")).collect()}

    versions = full_history(log)
    expected = {}
    for fact, user, ms in facts:
        match = [(v[1], v[2]) for v in versions if v[0] == user and v[2] <= ms and (v[3] is None or ms < v[3])]
        assert len(match) <= 1
        if match or how == "left":
            expected[fact] = match[0] if match else (None, None)
    assert got == expected
    assert joined.count() == len(expected)


def test_as_of_current_and_last_closed(spark, hot_history):
    log, history = hot_history
    versions = full_history(log)
    moment = log[700]["ts_ms"]
    got = as_of(history, F.timestamp_millis(F.lit(moment))).select("id", "status").collect()
    assert sorted(tuple(r) for r in got) == sorted((v[0], v[1]) for v in versions if v[2] <= moment and (v[3] is None or v[3] > moment))
    assert {r["id"] for r in current_rows(history).collect()} == {v[0] for v in versions if v[3] is None}
    ends = {r["id"]: r["ms"] for r in last_closed(history).select("id", millis("last_valid_to").alias("ms")).collect()}
    assert ends == {k: max(v[3] for v in versions if v[0] == k and v[3] is not None) for k in ends}


@pytest.mark.parametrize("limit", LIMITS)
def test_violations_are_found_and_a_sound_history_has_none(spark, hot_history, limit):
    _, history = hot_history
    assert history_violations(history, limit).isEmpty()
    key = current_rows(history).first()["id"]
    doubled = history.unionByName(current_rows(history).where(F.col("id") == key))
    assert [tuple(r) for r in history_violations(doubled, limit).collect()] == [(key, 2, 0, 1)]
    mislabelled = history.withColumn("_is_current", F.when(F.col("id") == key, False).otherwise(F.col("_is_current")))
    assert [tuple(r)[:3] for r in history_violations(mislabelled, limit).collect()] == [(key, 0, 1)]
    stretched = history.withColumn("_valid_to", F.col("_valid_to") + F.expr("INTERVAL 1 MINUTE"))
    report = {r["id"]: r["overlaps"] for r in history_violations(stretched, limit).collect()}
    spans = {}
    for row in stretched.select("id", "_valid_from", "_valid_to").collect():
        spans.setdefault(row["id"], []).append((row["_valid_from"], row["_valid_to"]))
    for key, rows in spans.items():
        rows.sort(key=lambda r: (r[0], r[1] is None, r[1] or r[0]))
        overlaps = sum(1 for a, b in zip(rows, rows[1:]) if a[1] is None or b[0] < a[1])
        assert report.get(key, 0) == overlaps


def test_hot_keys_are_cut_into_even_segments(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("o"))
    parts = balance(rows, "k", ["o"], max_rows=1000)
    assert parts.cold.count() == 10_000
    sizes = [r["count"] for r in parts.hot.groupBy(SEGMENT).count().collect()]
    assert sum(sizes) == 10_000 and len(sizes) >= 8 and max(sizes) < 2500
    near = with_neighbours(parts.hot, "k", ["o"], previous={"before": "o"}, following={"after": "o"})
    gaps = near.agg(
        F.count_if(F.col("o") - F.col("before") == 2).alias("previous"),
        F.count_if(F.col("after") - F.col("o") == 2).alias("next"),
    ).first()
    assert tuple(gaps) == (9_999, 9_999)


def test_no_hot_key_means_one_plain_window(spark):
    parts = balance(spark.range(1000).select(F.col("id").alias("k"), F.col("id").alias("o")), "k", ["o"])
    assert parts.hot is None


@pytest.mark.parametrize("limit", LIMITS)
def test_facts_without_a_key_keep_their_row_and_get_no_version(spark, hot_history, limit):
    _, history = hot_history
    facts = spark.range(60).select("id", F.lit(None).cast("bigint").alias("user"), F.current_timestamp().alias("at"))
    unkeyed = history.limit(1).withColumn("id", F.lit(None).cast("bigint"))
    joined = fact_join(facts, history.unionByName(unkeyed), "user", "at", ["status"], max_rows_per_key=limit)
    assert joined.count() == 60 and joined.where("_valid_from IS NOT NULL").isEmpty()


def test_rows_without_a_key_are_split_like_a_hot_key(spark):
    rows = spark.range(100).select(F.when(F.col("id") < 20, F.col("id")).alias("k"), F.col("id").alias("o"))
    parts = balance(rows, "k", ["o"], max_rows=10)
    assert parts.cold.count() == 20 and parts.hot.count() == 80
    near = with_neighbours(parts.hot, "k", ["o"], previous={"before": "o"})
    assert near.where(F.col("o") - F.col("before") == 1).count() == 79


def test_copies_of_one_event_are_cut_apart_and_fold_into_one_version(spark):
    log = random_log(21, keys=3, events=200)
    copies = decoded(spark, [e for e in log for _ in range(6)]).unionByName(decoded(spark, log[50:51] * 900).repartition(8))
    parts = balance(copies, "id", ["pg_lsn", "source_ts_ms", "kafka_offset"], max_rows=100)
    sizes = [r["count"] for r in parts.hot.groupBy(SEGMENT).count().collect()]
    assert sum(sizes) == 2100 and max(sizes) < 450
    history = build_history(copies, STATUS, max_rows_per_key=100)
    got = history.select("id", "status", millis("_valid_from"), millis("_valid_to"), "is_active", "_close_lsn").collect()
    assert sorted((tuple(r) for r in got), key=str) == full_history(log)


def test_many_equal_facts_of_one_instant_keep_their_number(spark, hot_history):
    log, history = hot_history
    version = current_rows(history).select("id", "status", "_valid_from").first()
    facts = spark.range(2000, numPartitions=16).select(
        F.lit(version["id"]).alias("user"), F.lit(version["_valid_from"]).cast("timestamp").alias("at")
    )
    joined = fact_join(facts, history, "user", "at", ["status"], max_rows_per_key=100)
    assert [tuple(r) for r in joined.groupBy("status").count().collect()] == [(version["status"], 2000)]


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("seed, statuses", [(41, 2), (42, 3), (43, 1)])  # few contents: many repetitions
def test_late_events_are_spliced_in(spark, limit, seed, statuses):
    import random

    log = random_log(seed, keys=8, events=240, hot_share=0.3, statuses=statuses)
    delivered = log[:]
    random.Random(seed).shuffle(delivered)
    parts = [delivered[:120], delivered[120:180] + delivered[:5], delivered[180:] + delivered[180:190]]  # some twice
    folder = spark.conf.get("spark.checkpoint.dir") + f"/splice-{seed}-{limit}"
    first = decoded(spark, parts[0])
    history, spine = build_history(first, STATUS), history_spine(first, STATUS)
    for number, late in enumerate(parts[1:]):
        history.write.mode("overwrite").parquet(f"{folder}/history-{number}")
        spine.dropDuplicates(["id", "kafka_offset"]).write.mode("overwrite").parquet(f"{folder}/spine-{number}")
        before = spark.read.parquet(f"{folder}/history-{number}")
        known = spark.read.parquet(f"{folder}/spine-{number}")
        history = splice_late(before, known, decoded(spark, late), STATUS, max_rows_per_key=limit)
        spine = known.unionByName(history_spine(decoded(spark, late), STATUS))
    got = sorted(str(r) for r in history.collect())
    assert got == sorted(str(r) for r in build_history(decoded(spark, log), STATUS).collect())


def test_splicing_leaves_other_versions_alone(spark):
    log = random_log(50, keys=3, events=200)
    missing = [e for e in log if 100 <= e["offset"] < 103]
    rest = decoded(spark, [e for e in log if e not in missing])
    folder = spark.conf.get("spark.checkpoint.dir") + "/splice-few"
    build_history(rest, STATUS).write.mode("overwrite").parquet(f"{folder}/history")
    history_spine(rest, STATUS).write.mode("overwrite").parquet(f"{folder}/spine")
    history, spine = spark.read.parquet(f"{folder}/history"), spark.read.parquet(f"{folder}/spine")
    assert sorted(map(str, splice_late(history, spine, rest.limit(0), STATUS).collect())) == sorted(map(str, history.collect()))
    spliced = splice_late(history, spine, decoded(spark, missing), STATUS)
    assert sorted(map(str, spliced.collect())) == sorted(map(str, build_history(decoded(spark, log), STATUS).collect()))
    touched = set(map(str, history.collect())) ^ set(map(str, spliced.collect()))
    assert len(touched) < 40


def test_segments_of_a_small_limit_do_not_make_a_task_each(spark):
    """A limit of ten rows cuts keys into runs of ten, in a number of tasks that follows the rows."""
    rows = spark.range(3000).selectExpr("id % 3 AS k", "id AS o")
    hot = balance(rows, "k", ["o"], 10).hot
    assert hot.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    found = hot.groupBy("k", SEGMENT).agg(F.count("*").alias("n"), F.min("o").alias("lo"), F.max("o").alias("hi")).collect()
    assert sum(r.n for r in found) == 3000 and max(r.n for r in found) <= 10
    for k in range(3):
        runs = sorted((r[SEGMENT], r.lo, r.hi) for r in found if r.k == k)
        assert all(a[2] < b[1] for a, b in zip(runs, runs[1:]))  # segments follow the order
