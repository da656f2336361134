"""Rules, specs, casts and hashes."""

import hashlib

import pytest
from pyspark.sql import functions as F

from chronolake.functions.hashing import content_hash
from chronolake.functions.rules import Buckets, Case, RegexGroup, rule_from_config
from chronolake.functions.specs import ENTITIES, ORDERS, PRODUCTS, USERS, EntitySpec, from_connector_decimal
from chronolake.operators.decode import decode_payload, latest_per_key, with_row_hash


def values(frame):
    return [r[0] for r in frame.collect()]


def test_regex_rule(spark):
    rows = spark.createDataFrame([("a@b.org",), ("a@b@c",), ("none",), (None,)], "email string")
    assert values(rows.select(RegexGroup("email", "@(.+)$").build())) == ["b.org", "b@c", "", None]


def test_bucket_rule_takes_the_first_case_and_else_for_null(spark):
    rows = spark.createDataFrame([(10.0,), (50.0,), (199.99,), (200.0,), (None,)], "price double")
    assert values(rows.select(PRODUCTS.rules["price_category"].build())) == ["Low", "Medium", "Medium", "High", "High"]
    rows = spark.createDataFrame([(99.99,), (100.0,), (500.0,)], "total_amount double")
    assert values(rows.select(ORDERS.rules["order_value_category"].build())) == ["Small", "Medium", "Large"]


def test_all_comparisons(spark):
    rule = Buckets((Case("x", "==", 5, "five"), Case("x", ">", 5, "more")))
    rows = spark.createDataFrame([(5,), (6,), (4,)], "x int")
    assert values(rows.select(rule.build())) == ["five", "more", None]


def test_rules_from_config():
    assert rule_from_config({"expr": "regexp_extract", "params": ["email", "@(.+)$", 1]}) == RegexGroup("email", "@(.+)$", 1)
    config = {"expr": "when", "params": [{"expr": "<", "col": "p", "val": 50, "then": "Low"}, {"else": "High"}]}
    assert rule_from_config(config) == Buckets((Case("p", "<", 50, "Low"),), "High")


@pytest.mark.parametrize(
    "bad",
    [
        {"expr": "upper", "params": ["x"]},
        {"expr": "when", "params": [{"expr": "<=", "col": "p", "val": 1, "then": "x"}]},
        {"expr": "when", "params": [{"else": "x"}]},
    ],
)
def test_unknown_rules_are_errors(bad):
    with pytest.raises(ValueError):
        rule_from_config(bad)


def test_spec_from_config_and_checks():
    config = {
        "columns": ["id", "price", "name"],
        "types": {"id": "bigint", "price": "double"},
        "transforms": {"cheap": {"expr": "when", "params": [{"expr": "<", "col": "price", "val": 5, "then": "y"}]}},
    }
    spec = EntitySpec.from_config("things", config)
    assert spec.columns == {"id": "bigint", "price": "double", "name": "string"}
    assert spec.business() == ["id", "price", "name", "cheap", "is_active"]
    with pytest.raises(ValueError):
        EntitySpec("broken", {"name": "string"})
    with pytest.raises(ValueError):
        EntitySpec("broken", {"id": "bigint", "x": "int"}, {"x": RegexGroup("id", ".")})
    assert list(ENTITIES) == ["users", "products", "orders"]


def log_rows(spark, images):
    rows = [(op, before, after, n, n) for n, (op, before, after) in enumerate(images)]
    frame = spark.createDataFrame(rows, "operation string, before_json string, after_json string, kafka_offset bigint, pg_lsn bigint")
    return frame.withColumns(
        {"source_ts_ms": F.col("pg_lsn"), "processed_at": F.timestamp_millis("pg_lsn"), "kafka_partition": F.lit(0)}
    )


def test_decode_casts_leniently_and_ignores_unknown_fields(spark):
    frame = decode_payload(
        log_rows(
            spark,
            [
                ("c", None, '{"id": 1, "name": "Pen", "price": "abc", "color": "red"}'),
                ("u", None, '{"id": "2", "price": "49.5", "created_at": 12.7}'),
                ("d", '{"id": 3}', None),
                ("c", None, '{"id": 9007199254740993, "price": 1e2}'),
                ("c", None, "broken"),
            ],
        ),
        PRODUCTS,
    )
    rows = {r["kafka_offset"]: r for r in frame.collect()}
    assert (rows[0]["id"], rows[0]["name"], rows[0]["price"], rows[0]["price_category"]) == (1, "Pen", None, "High")
    assert (rows[1]["id"], rows[1]["price"], rows[1]["created_at"], rows[1]["price_category"]) == (2, 49.5, 12, "Low")
    assert (rows[2]["id"], rows[2]["is_active"], rows[2]["operation"]) == (3, False, "d")
    assert (rows[3]["id"], rows[3]["price"]) == (9007199254740993, 100.0)
    assert rows[4]["id"] is None and rows[4]["is_active"] is True


def test_latest_per_key_orders_by_position_then_time_and_puts_null_last(spark):
    rows = spark.createDataFrame(
        [(1, None, 9, 9, "old"), (1, 5, 1, 1, "mid"), (1, 5, 2, 0, "new"), (2, None, 1, 1, "a"), (2, None, 1, 2, "b")],
        "id int, pg_lsn bigint, source_ts_ms bigint, kafka_offset bigint, tag string",
    )
    assert {r["id"]: r["tag"] for r in latest_per_key(rows).collect()} == {1: "new", 2: "b"}


def test_hash_forms(spark):
    rows = spark.createDataFrame([("a||b", None), ("a", "b||NULL"), ("x", "NULL"), ("x", None)], "p string, q string")
    plain = values(rows.select(content_hash(["p", "q"])))
    assert plain[0] == hashlib.sha256(b"a||b||NULL").hexdigest() and plain[0] == plain[1] and plain[2] == plain[3]
    assert len(set(values(rows.select(content_hash(["p", "q"], length_prefixed=True))))) == 4


def test_row_hash_covers_derived_columns_and_live_flag(spark):
    decoded = decode_payload(log_rows(spark, [("c", None, '{"id": 1, "name": "N", "email": "n@x.y"}')]), USERS)
    assert with_row_hash(decoded, USERS).first()["_hash"] == hashlib.sha256(b"1||N||n@x.y||NULL||NULL||x.y||true").hexdigest()


def test_numbers_that_are_no_amounts_become_null(spark):
    spec = ENTITIES["orders"]
    rows = spark.createDataFrame([("NaN",), ("Infinity",), ("-Infinity",), ("12.5",), ("x",)], "total_amount string")
    typed = rows.select(F.struct(*[F.col("total_amount") if c == "total_amount" else F.lit(None).cast("string").alias(c) for c in spec.columns]).alias("p"))
    assert [r.total_amount for r in typed.select(*spec.typed("p")).collect()] == [None, None, None, 12.5, None]


def test_connector_decimals(spark):
    texts = [("AfvP",), ("AA==",), ("/w==",), ("gAAAAAAAAAA=",), ("f/////////8=",), ("AAAAAAAAAAAA",), ("*",), (None,)]
    rows = spark.createDataFrame(texts, "t string").select(from_connector_decimal(F.col("t"), 2).alias("v")).collect()
    assert [r.v for r in rows] == [1299.99, 0.0, -0.01, -(2**63) / 100, (2**63 - 1) / 100, None, None, None]
