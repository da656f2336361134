"""Silver tables written by deltas: the model's rows after every run and fold, little written, nothing lost to dead runs."""

import json
import random

import pytest
from pyspark.sql import functions as F

from chronolake.checks.inputs import STATUS
from chronolake.operators.quality import history_violations
from chronolake.warehouse import SilverTable, _partitions, ensure_database
from events import random_log
from model import Silver, full_history

START = 1_704_067_200_000


def raw_log(spark, log, batch=0):
    rows = []
    for e in log:
        image = json.dumps({"id": e["id"], "status": e["status"]})
        before, after = (image, None) if e["op"] == "d" else (None, image)
        rows.append(("users", e["op"], before, after, e["ts_ms"], 0, e["offset"], e["lsn"], batch))
    schema = (
        "source_table string, operation string, before_json string, after_json string, source_ts_ms bigint, "
        "kafka_partition int, kafka_offset bigint, pg_lsn bigint, _batch_id bigint"
    )
    return spark.createDataFrame(rows, schema).withColumn("processed_at", F.timestamp_millis("source_ts_ms"))


def plain(table, spark):
    rows = spark.table(table.view).select("id", "status", F.unix_millis("_valid_from"), F.unix_millis("_valid_to"), "is_active")
    return sorted((tuple(r) for r in rows.collect()), key=str)


def new_table(spark, name, buckets=4):
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    ensure_database(spark, name)
    return SilverTable(name, STATUS, buckets)


def files(spark, table, kind=None):
    """Data files of a table by name with their sizes."""
    from pathlib import Path

    place = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()["data_type"].removeprefix("file:")
    return {str(f): f.stat().st_size for f in Path(place).rglob("*.parquet") if kind is None or f"_kind={kind}" in str(f)}


@pytest.mark.parametrize("fold_after", [None, 0])
def test_runs_and_folds_equal_the_model(spark, fold_after):
    log = random_log(21, keys=30, events=500)
    rng = random.Random(3)
    cuts = sorted(rng.sample(range(1, len(log)), 4))
    table, model = new_table(spark, f"deltas_{fold_after}"), Silver()
    for number, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(log)])):
        batch = log[max(0, a - 40) : b]  # some events come again
        result = table.refine(raw_log(spark, batch, number), F.timestamp_millis(F.lit(START + number)))
        assert result["staged"] == len({e["id"] for e in batch})
        model.step(batch, START + number)
        assert plain(table, spark) == model.rows()
        if fold_after is not None:
            table.fold(spark, fold_after)
            assert plain(table, spark) == model.rows()
    history = spark.table(table.view)
    assert history_violations(history).isEmpty()
    live = {k: v["event"]["status"] for k, v in model.open.items()}
    assert {r.id: r.status for r in history.where("_is_current").collect()} == live
    kinds = {p["_kind"] for p in _partitions(spark, table.versions)}
    assert kinds == ({"delta", "closed"} if fold_after is None else kinds) and (fold_after is None or {"base", "pack"} <= kinds)


def test_a_small_batch_writes_little_and_a_fold_only_what_gathered(spark):
    table = new_table(spark, "deltas_small", buckets=16)
    many = [{"id": i, "status": f"s{i}-{i * 7919 % 10_007}", "op": "c", "ts_ms": START + i, "lsn": i, "offset": i} for i in range(200_000)]
    table.refine(raw_log(spark, many, 0), F.timestamp_millis(F.lit(START)))
    first = files(spark, table.versions)
    few = [{"id": i, "status": "new", "op": "u", "ts_ms": START + 10**6, "lsn": 10**6 + i, "offset": 10**6 + i} for i in (3, 5, 8)]
    table.refine(raw_log(spark, few, 1), F.timestamp_millis(F.lit(START + 1)))
    added = {f: n for f, n in files(spark, table.versions).items() if f not in first}
    assert all(f in files(spark, table.versions) for f in first)  # nothing was rewritten
    assert len(added) <= 2 * len(few)
    assert sum(added.values()) < 0.05 * sum(first.values())
    assert sum(files(spark, table.fences).values()) < 0.05 * sum(first.values())

    # Only slices that gathered more runs than others are rewritten.
    folded = table.fold(spark, 1)
    assert 1 <= len(folded) <= 3
    base = files(spark, table.versions, "base")
    assert 0 < sum(base.values()) < 0.3 * sum(first.values())
    assert spark.table(table.view).where("_is_current").count() == 200_000
    assert table.fold(spark, 1) == []


def test_deleted_keys_stay_deleted_through_folds(spark):
    """A marker hides older rows until these are gone; a later insert shows again."""
    table = new_table(spark, "deltas_deletes", buckets=2)
    steps = [("c", "a"), ("d", None), ("u", "b"), ("d", None), ("c", "c")]
    for number, (op, status) in enumerate(steps):
        event = {"id": 1, "status": status, "op": op, "ts_ms": START + number, "lsn": number + 1, "offset": number}
        table.refine(raw_log(spark, [event], number))
        shown = [r.status for r in spark.table(table.view).where("_is_current").collect()]
        assert shown == ([status] if op != "d" else [])
        if number % 2:
            table.fold(spark, 0)
            table.fold(spark, 0)
            assert [r.status for r in spark.table(table.view).where("_is_current").collect()] == shown
        replay = {"id": 1, "status": "old", "op": "u", "ts_ms": START, "lsn": 1, "offset": 0}
        table.refine(raw_log(spark, [replay], number))  # an old event behind the mark or the fence
        assert [r.status for r in spark.table(table.view).where("_is_current").collect()] == shown
    assert spark.table(table.view).where("NOT _is_current").count() == 2


def test_a_dead_run_leaves_no_trace(spark):
    table = new_table(spark, "deltas_dead", buckets=2)
    log = random_log(5, keys=6, events=60)
    table.refine(raw_log(spark, log[:40], 0), F.timestamp_millis(F.lit(START)))
    shown = plain(table, spark)
    rows = spark.table(table.versions)
    for kind in ("base", "delta", "closed", "pack"):  # what runs of any kind may have written before they died
        stray = rows.withColumns({"_run_id": F.lit(2).cast("bigint"), "_kind": F.lit(kind), "_dropped": F.lit(kind == "delta")})
        stray.select(rows.columns).write.insertInto(table.versions)
    spark.table(table.fences).withColumn("_run_id", F.lit(2).cast("bigint")).write.insertInto(table.fences)
    assert plain(table, spark) == shown
    model = Silver()
    model.step(log[:40], START)
    model.step(log[40:], START + 1)
    table.refine(raw_log(spark, log[40:], 1), F.timestamp_millis(F.lit(START + 1)))
    assert plain(table, spark) == model.rows()


def test_readers_of_the_view_before_keep_their_rows(spark):
    table = new_table(spark, "deltas_readers", buckets=2)
    log = random_log(6, keys=6, events=60)
    table.refine(raw_log(spark, log, 0), F.timestamp_millis(F.lit(START)))
    reader = spark.table(table.view)
    count = reader.count()
    table.fold(spark, 0)
    assert reader.count() == count


def test_rebuild_holds_every_change_and_later_runs_go_on(spark):
    log = random_log(31, keys=12, events=300)
    table = new_table(spark, "deltas_rebuild")
    table.refine(raw_log(spark, log[:100], 0), F.timestamp_millis(F.lit(START)))
    table.rebuild(raw_log(spark, log[:200], 0))
    rows = spark.table(table.view)
    got = rows.select("id", "status", F.unix_millis("_valid_from"), F.unix_millis("_valid_to"), "is_active", "_close_lsn").collect()
    assert sorted((tuple(r) for r in got), key=str) == full_history(log[:200])
    assert table.refine(raw_log(spark, log[:200], 0)) is None  # the rebuild has read it
    table.refine(raw_log(spark, log[200:], 1), F.timestamp_millis(F.lit(log[-1]["ts_ms"] + 1)))
    table.fold(spark, 0)
    table.fold(spark, 0)
    newest = {}
    for e in log:
        if e["id"] not in newest or (e["lsn"], e["ts_ms"], e["offset"]) > newest[e["id"]][0]:
            newest[e["id"]] = ((e["lsn"], e["ts_ms"], e["offset"]), e)
    live = {(k, e["status"]) for k, (_, e) in newest.items() if e["op"] != "d"}
    assert {(r.id, r.status) for r in spark.table(table.view).where("_is_current").collect()} == live
