"""The merge step against a row-by-row model, over cut, overlapping and replayed batches."""

import random

import pytest
from pyspark.sql import functions as F

from chronolake.checks.inputs import STATUS
from chronolake.operators.decode import latest_per_key, with_row_hash
from chronolake.operators.history import current_rows
from chronolake.operators.quality import history_violations
from chronolake.operators.scd2 import (
    advance_fences,
    apply_scd2,
    empty_silver,
    fences,
    merge_staging,
    merge_statement,
    plan_actions,
    unseen_rows,
)
from events import decoded, random_log
from model import Silver, latest

START = 1_704_067_200_000


def run_batches(spark, batches):
    """Apply batches in turn; rows of all steps, and the model's."""
    folder = spark.conf.get("spark.checkpoint.dir") + f"/scd2-{random.random()}"
    model, known = Silver(), None
    open_rows, closed = empty_silver(spark, STATUS), empty_silver(spark, STATUS)
    for number, batch in enumerate(batches):
        stamp = START + number
        staged = latest_per_key(decoded(spark, batch))
        rows = apply_scd2(open_rows, staged, STATUS, F.timestamp_millis(F.lit(stamp)), known)
        rows.write.parquet(f"{folder}/{number}")
        rows = spark.read.parquet(f"{folder}/{number}")
        advance_fences(known, staged).write.parquet(f"{folder}/fences-{number}")
        known = spark.read.parquet(f"{folder}/fences-{number}")
        open_rows, closed = current_rows(rows), closed.unionByName(rows.where("NOT _is_current"))
        model.step(batch, stamp)
    return open_rows.unionByName(closed), model, known


def plain(history):
    rows = history.select("id", "status", F.unix_millis("_valid_from"), F.unix_millis("_valid_to"), "is_active").collect()
    return sorted((tuple(r) for r in rows), key=str)


@pytest.mark.parametrize("seed", [11, 12])
def test_ordered_batches_with_overlap_end_in_the_latest_state(spark, seed):
    log = random_log(seed, keys=60, events=900)
    rng = random.Random(seed)
    cuts = sorted(rng.sample(range(1, len(log)), 4))
    batches = [log[max(0, a - 60) : b] for a, b in zip([0, *cuts], [*cuts, len(log)])]
    history, model, _ = run_batches(spark, batches)
    assert plain(history) == model.rows()
    assert history_violations(history).isEmpty()
    live = {(e["id"], e["status"]) for e in latest(log).values() if e["op"] != "d"}
    assert {(r["id"], r["status"]) for r in current_rows(history).collect()} == live


def test_shuffled_and_replayed_batches_keep_the_invariants(spark):
    log = random_log(13, keys=60, events=900)
    batches = [log[i : i + 225] for i in range(0, 900, 225)]
    random.Random(5).shuffle(batches)
    history, model, known = run_batches(spark, [*batches, batches[0], batches[0]])
    assert plain(history) == model.rows()
    assert history_violations(history).isEmpty()
    live = {(e["id"], e["status"]) for e in latest(log).values() if e["op"] != "d"}
    assert {(r["id"], r["status"]) for r in current_rows(history).collect()} == live

    again = latest_per_key(decoded(spark, batches[0]))
    actions = plan_actions(current_rows(history), again, STATUS, known).select("action").distinct().collect()
    assert {a for (a,) in actions} <= {"KEEP", "SKIP"}


def event(key, op, lsn, status=None):
    return {"id": key, "status": status, "op": op, "ts_ms": START + lsn, "lsn": lsn, "offset": lsn}


def test_each_case_of_the_contract(spark):
    before = [event(k, "c", 10, "a") for k in (1, 2, 3, 4, 5, 6)] + [event(8, "d", 10)]
    batch = [
        event(1, "d", 20),
        event(2, "u", 20, "a"),
        event(3, "u", 20, "b"),
        event(4, "u", 5, "b"),
        event(5, "d", 5),
        event(7, "d", 20),
        event(8, "c", 5, "a"),
        event(9, "c", 20, "a"),
    ]
    first = latest_per_key(decoded(spark, before))
    open_rows = apply_scd2(empty_silver(spark, STATUS), first, STATUS, F.timestamp_millis(F.lit(START)))
    staged = latest_per_key(decoded(spark, batch))
    planned = plan_actions(open_rows, staged, STATUS, advance_fences(None, first)).select("id", "action").collect()
    assert dict(map(tuple, planned)) == {
        1: "CLOSE",
        2: "TOUCH",
        3: "CLOSE_AND_INSERT",
        4: "SKIP",
        5: "SKIP",
        6: "KEEP",
        7: "SKIP",
        8: "SKIP",
        9: "INSERT",
    }
    after = apply_scd2(open_rows, staged, STATUS, F.timestamp_millis(F.lit(START + 99)), advance_fences(None, first))
    rows = {(r["id"], r["_is_current"]): r for r in after.collect()}
    assert rows[2, True]["pg_lsn"] == 20 and rows[2, True]["operation"] == "c"
    assert rows[1, False]["_close_lsn"] == 20 and rows[1, False]["is_active"] is False
    assert rows[3, False]["_valid_to"] == rows[3, True]["_valid_from"]
    assert rows[3, False]["is_active"] is True and rows[4, True]["status"] == "a"
    assert len(rows) == 8
    assert dict(fences(after.where("NOT _is_current")).select("id", "fence.pg_lsn").collect()) == {1: 20, 3: 20}


def test_replayed_batch_has_no_unseen_rows(spark):
    batch = with_row_hash(latest_per_key(decoded(spark, [event(1, "c", 1, "a"), event(2, "c", 2, "b")])), STATUS)
    open_rows = apply_scd2(empty_silver(spark, STATUS), batch, STATUS, F.timestamp_millis(F.lit(START)))
    assert unseen_rows(batch, open_rows, STATUS).isEmpty()
    changed = latest_per_key(decoded(spark, [event(1, "u", 3, "z"), event(2, "u", 4, "b")]))
    assert [r["id"] for r in unseen_rows(changed, open_rows, STATUS).collect()] == [1]


def test_merge_statement_is_valid_sql_and_inserts_every_open_column(spark):
    text = merge_statement("silver", "staging", STATUS)
    assert "MergeIntoTable" in spark._jsparkSession.sessionState().sqlParser().parsePlan(text).getClass().getName()
    assert all(f"`{c}`" in text for c in STATUS.silver_types() if not c.startswith("_close"))
    assert text.count("WHEN MATCHED") == 2 and text.count("WHEN NOT MATCHED") == 1


def test_merge_actions_give_what_the_step_gives(spark):
    """The statement's clauses carried out row by row, old events and a create after a delete included."""
    first = latest_per_key(decoded(spark, [event(i, "c", i, "a") for i in range(1, 6)] + [event(6, "d", 9)]))
    stamp = [F.timestamp_millis(F.lit(START + n)) for n in (1, 2)]
    before = apply_scd2(empty_silver(spark, STATUS), first, STATUS, stamp[0])
    known = advance_fences(None, first)
    news = [event(1, "d", 21), event(2, "u", 22, "b"), event(3, "u", 23, "a"), event(4, "u", 1, "z"), event(6, "c", 7, "x"), event(7, "c", 24, "n")]
    batch = latest_per_key(decoded(spark, news))
    table = [r.asDict() for r in before.collect()]
    for s in merge_staging(plan_actions(before, batch, STATUS, known), STATUS, stamp[1]).collect():
        matches = [t for t in table if t["id"] == s["_merge_key"] and t["_is_current"]]
        for t in matches:
            if s["_action"] == "TOUCH":
                t.update({c: s[c] for c in ("source_ts_ms", "processed_at", "kafka_partition", "kafka_offset", "pg_lsn", "_cdc_order_lsn") if c in t})
            elif s["_action"] == "CLOSE":
                t.update(is_active=t["is_active"] and s["is_active"], _valid_to=s["_valid_from"], _is_current=False)
                t.update({c: s[c] for c in s.asDict() if c.startswith("_close")})
        if not matches and s["_action"] == "INSERT":
            table.append({c: None if c.startswith("_close") else s[c] for c in table[0]})
    expected = [r.asDict() for r in apply_scd2(before, batch, STATUS, stamp[1], known).collect()]
    assert sorted(map(str, (sorted(r.items()) for r in table))) == sorted(map(str, (sorted(r.items()) for r in expected)))


def test_events_without_a_log_position_are_ordered_by_time(spark):
    def unplaced(op, ts_ms, status=None):
        return {"id": 1, "status": status, "op": op, "ts_ms": ts_ms, "lsn": None, "offset": ts_ms}

    first = latest_per_key(decoded(spark, [unplaced("c", 10, "a"), unplaced("u", 20, "b")]))
    open_rows = apply_scd2(empty_silver(spark, STATUS), first, STATUS, F.timestamp_millis(F.lit(1)))
    actions = {}
    for event in (unplaced("u", 15, "c"), unplaced("u", 30, "c"), {**unplaced("u", 5, "c"), "lsn": 1}):
        staged = latest_per_key(decoded(spark, [event]))
        actions[event["ts_ms"]] = plan_actions(open_rows, staged, STATUS).first()["action"]
    assert actions == {15: "SKIP", 30: "CLOSE_AND_INSERT", 5: "CLOSE_AND_INSERT"}
