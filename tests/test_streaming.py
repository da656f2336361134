"""File streams: restart, duplicate deliveries, replayed batches, both writers."""

import pytest
from pyspark.sql import functions as F

from chronolake.operators.envelope import parse_envelope, split_events
from chronolake.sources.files import read_record_files
from chronolake.streaming.ingest import (
    progress_rows,
    start_dead_letter_writer,
    start_log_writer,
    start_split_ingest,
)
from shop import Feed, write_records


def offsets(frame):
    return sorted(r["kafka_offset"] for r in frame.select("kafka_offset").collect())


def test_native_writers_resume_and_drop_second_deliveries(spark, tmp_path):
    feed = Feed()
    first = feed.seeds()

    def run():
        good, dead = split_events(parse_envelope(read_record_files(spark, str(tmp_path / "in"))))
        log = start_log_writer(good, str(tmp_path / "log"), str(tmp_path / "c1"), interval=None)
        log.awaitTermination()
        start_dead_letter_writer(dead, str(tmp_path / "dead"), str(tmp_path / "c2"), interval=None).awaitTermination()
        return log

    write_records(tmp_path / "in", "1.json", first + [first[0], feed.raw("junk")])
    query = run()
    assert [row[0] for row in progress_rows(query)][:1] == ["raw-log-writer"]
    assert sum(row[2] for row in progress_rows(query)) == 25
    log, dead = spark.read.parquet(str(tmp_path / "log")), spark.read.json(str(tmp_path / "dead"))
    assert offsets(log) == list(range(1, 24)) and dead.count() == 1
    assert {"source_table", "ingest_date"} <= set(log.columns)

    write_records(tmp_path / "in", "2.json", [first[3], feed.record("users", "u", {"id": 1})])
    run()
    assert offsets(spark.read.parquet(str(tmp_path / "log"))) == [*range(1, 24), 25]
    run()
    assert offsets(spark.read.parquet(str(tmp_path / "log"))) == [*range(1, 24), 25]


def test_split_ingest_writes_both_logs_once(spark, tmp_path):
    feed = Feed()
    first = feed.seeds()

    def run():
        records = read_record_files(spark, str(tmp_path / "in"), max_files_per_trigger=1)
        query = start_split_ingest(records, str(tmp_path / "log"), str(tmp_path / "dead"), str(tmp_path / "c"), interval=None)
        query.awaitTermination()

    write_records(tmp_path / "in", "1.json", first + [first[5]])
    write_records(tmp_path / "in", "2.json", [first[0], feed.raw("junk"), feed.record("orders", "x", {"id": 1})])
    run()
    log, dead = spark.read.parquet(str(tmp_path / "log")), spark.read.json(str(tmp_path / "dead"))
    assert offsets(log) == list(range(1, 24))
    assert {r["error_type"] for r in dead.collect()} == {"NULL_OPERATION", "INVALID_OPERATION"}

    # A crash after the batch was written but before it was committed: the batch runs again.
    # (The state of the last batch is taken back by pointing a copy at the commit before it.)
    commits = sorted(p for p in (tmp_path / "c" / "commits").iterdir() if p.name.isdigit())
    commits[-1].unlink()
    (tmp_path / "c" / "commits" / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    run()
    assert offsets(spark.read.parquet(str(tmp_path / "log"))) == list(range(1, 24))
    assert spark.read.json(str(tmp_path / "dead")).count() == 2


def test_copies_spread_over_tasks_are_still_found(spark, tmp_path):
    feed = Feed()
    records = feed.seeds()
    for n in range(6):
        write_records(tmp_path / "in", f"{n}.json", records + [records[3]] * 50)

    def run():
        source = read_record_files(spark, str(tmp_path / "in"), max_files_per_trigger=4)
        good, _ = split_events(parse_envelope(source))
        start_log_writer(good, str(tmp_path / "log"), str(tmp_path / "c"), interval=None, copy_tasks=4).awaitTermination()
        return offsets(spark.read.parquet(str(tmp_path / "log")))

    assert run() == list(range(1, 24))
    write_records(tmp_path / "in", "late.json", [records[3], feed.record("users", "u", {"id": 1})])
    assert run() == list(range(1, 25))


def test_old_events_are_never_too_late(spark, tmp_path):
    """The watermark follows the ingest clock, so a backlog of any age passes."""
    feed = Feed()
    records = feed.seeds()
    for position, record in enumerate(records):
        record["timestamp"] = f"20{10 + position % 15}-01-01T00:00:00.000Z"
    for n in range(4):
        write_records(tmp_path / "in", f"{n}.json", records[n::4][::-1])
    good, _ = split_events(parse_envelope(read_record_files(spark, str(tmp_path / "in"), max_files_per_trigger=1)))
    start_log_writer(good, str(tmp_path / "log"), str(tmp_path / "c"), interval=None, delay="1 second").awaitTermination()
    assert offsets(spark.read.parquet(str(tmp_path / "log"))) == list(range(1, 24))
    days = spark.read.parquet(str(tmp_path / "log")).select(F.countDistinct("kafka_timestamp")).first()[0]
    assert days == 15


def test_await_any_stops_the_other_queries(spark):
    from chronolake.streaming.ingest import await_any

    def endless(name, fails):
        def write(batch, number):
            if fails and number >= 1:
                raise RuntimeError("stop")

        rows = spark.readStream.format("rate").option("rowsPerSecond", 5).load()
        return rows.writeStream.queryName(name).foreachBatch(write).trigger(processingTime="200 milliseconds").start()

    running = [endless("steady", False), endless("failing", True)]
    with pytest.raises(Exception, match="stop"):
        await_any(spark, running)
    assert not any(q.isActive for q in running)
    spark.streams.resetTerminated()


def test_a_log_takes_one_checkpoint_only(spark, tmp_path):
    feed = Feed()
    write_records(tmp_path / "in", "1.json", feed.seeds())

    def run(log, checkpoint):
        records = read_record_files(spark, str(tmp_path / "in"))
        start_split_ingest(records, f"{tmp_path}/{log}", f"{tmp_path}/dead-{log}", f"{tmp_path}/{checkpoint}", interval=None).awaitTermination()

    run("log", "c1")
    run("log", "c1")
    run("other", "c2")
    for checkpoint in ("new", "c2"):  # a new one, and that of another log
        with pytest.raises(ValueError, match="another checkpoint"):
            run("log", checkpoint)
    assert offsets(spark.read.parquet(f"{tmp_path}/log")) == list(range(1, 24))
