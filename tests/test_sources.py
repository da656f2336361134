"""Kafka options, file streams, snapshots, session helpers."""

import json

import pytest
from pyspark.sql import functions as F

from chronolake.functions.specs import USERS
from chronolake.operators.decode import decode_payload
from chronolake.operators.envelope import parse_envelope, split_events
from chronolake.session import fresh_folder, iceberg_conf, shared_folder, spread
from chronolake.sources.kafka import kafka_options
from chronolake.sources.snapshots import diff_snapshots, snapshot_to_events


def test_kafka_options_without_and_with_login():
    plain = kafka_options("broker:9092", ["a", "b"])
    assert plain == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "a,b",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "50000",
        "kafka.security.protocol": "PLAINTEXT",
    }
    assert kafka_options("b", username="u") == kafka_options("b")
    login = kafka_options("b", username="u", password="p", security_protocol="SASL_SSL")
    assert login["kafka.sasl.mechanism"] == "SCRAM-SHA-256"
    assert 'username="u" password="p";' in login["kafka.sasl.jaas.config"]


def test_snapshot_rows_become_rows_again(spark):
    rows = spark.createDataFrame([(1, "Ann", "a@b.c"), (2, None, "x@y.z")], "id bigint, name string, email string")
    events = snapshot_to_events(rows, "users", "id", ts_ms=1000, lsn=7)
    assert json.loads(events.where("key = '2'").first()["value"])["after"] == {"id": 2, "name": None, "email": "x@y.z"}
    columns = {"topic": F.lit("t"), "partition": F.lit(0), "offset": F.lit(1), "timestamp": F.current_timestamp()}
    good, dead = split_events(parse_envelope(events.withColumns(columns), snapshot_ops=("r",)))
    assert dead.isEmpty()
    back = decode_payload(good, USERS).select("id", "name", "email", "operation", "source_ts_ms", "pg_lsn")
    assert sorted(tuple(r) for r in back.collect()) == [(1, "Ann", "a@b.c", "c", 1000, 7), (2, None, "x@y.z", "c", 1000, 7)]


def test_snapshot_difference(spark):
    old = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (4, "d")], "id bigint, v string")
    new = spark.createDataFrame([(1, "a"), (2, None), (3, "z"), (5, None)], "id bigint, v string")
    found = {r["key"]: (r["op"], r["before_json"], r["after_json"]) for r in diff_snapshots(old, new, "id").collect()}
    assert found == {
        "3": ("u", '{"id":3,"v":"c"}', '{"id":3,"v":"z"}'),
        "4": ("d", '{"id":4,"v":"d"}', None),
        "5": ("c", None, '{"id":5,"v":null}'),
    }


def test_iceberg_profile():
    conf = iceberg_conf("lake", "s3://somewhere/", catalog_impl="some.Catalog")
    assert conf["spark.sql.catalog.lake.catalog-impl"] == "some.Catalog"
    assert conf["spark.sql.catalog.lake.commit.retry.num-retries"] == "10"


def test_shared_folder_is_the_configured_one(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    one, two = fresh_folder(spark, "x"), fresh_folder(spark, "x")
    assert one != two and one.startswith(folder)


class ClusterSession:
    """Stands for a cluster session without a checkpoint folder."""

    class conf:
        get = staticmethod(lambda name, default: default)

    class sparkContext:
        master = "spark://cluster:7077"
        getCheckpointDir = staticmethod(lambda: None)


def test_a_cluster_without_shared_folder_is_an_error():
    with pytest.raises(RuntimeError):
        shared_folder(ClusterSession())


def test_spread_only_widens_narrow_sources(spark):
    assert spread(spark.range(100, numPartitions=1)).rdd.getNumPartitions() == 8
    wide = spark.range(100, numPartitions=20)
    assert spread(wide) is wide


def test_differences_read_only_changed_ranges(spark, tmp_path):
    from chronolake.sources.snapshot_trees import _within, changed_ranges, diff_trees, write_snapshot
    from chronolake.sources.snapshots import diff_snapshots

    old = spark.range(-500, 4500).selectExpr("id AS k", "IF(id % 7 = 0, NULL, concat('v', id)) AS a", "CAST(NULL AS STRING) AS b")
    changed = "CASE WHEN k = 1205 THEN 'new' WHEN k = -3 THEN NULL ELSE a END"
    # A value that moves to the neighbouring column, a deleted row, an inserted one, and a row without a key.
    new = old.where("k <> 4001").selectExpr("k", f"IF(k = 2222, NULL, {changed}) AS a", "IF(k = 2222, a, b) AS b")
    new = new.unionByName(spark.createDataFrame([(9000, "x", "y"), (None, "n", None)], "k bigint, a string, b string"))
    first = write_snapshot(old, "k", f"{tmp_path}/old", width=100, fan=4)
    second = write_snapshot(new, "k", f"{tmp_path}/new", width=100, fan=4)
    found = changed_ranges(first, second, spark)
    assert {r[0] for r in found.collect()} == {12, -1, 22, 40, 90, None}
    expected = diff_snapshots(old, new, "k").collect()
    assert sorted(map(str, diff_trees(first, second, "k", spark).collect())) == sorted(map(str, expected))
    read = _within(second.rows(spark), found, "_range").selectExpr("input_file_name()").distinct().count()
    assert read <= 6 < second.rows(spark).selectExpr("input_file_name()").distinct().count()
    assert diff_trees(first, first, "k", spark).count() == 0
    none = write_snapshot(old.limit(0), "k", f"{tmp_path}/none", width=100, fan=4)
    assert diff_trees(none, none, "k", spark).count() == 0
