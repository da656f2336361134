"""Change records, order facts and current rows derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolake.functions.rules import Buckets, Case, RegexGroup
from chronolake.functions.specs import EntitySpec
from chronolake.operators.decode import decode_payload
from chronolake.operators.envelope import parse_envelope
from chronolake.session import spread
from chronolake.sources.snapshots import envelope_json

TOPIC = "cdc.public.users"

# Entities as the change log of ``events`` carries them.
ACCOUNT = EntitySpec("users", {"id": "bigint", "status": "string", "amount": "double", "k": "bigint"})
VISIT = EntitySpec("users", {"id": "bigint", "status": "string", "k": "bigint"})
STATUS = EntitySpec("users", {"id": "bigint", "status": "string"})

PRICE_RULE = Buckets((Case("price", "<", 50, "Low"), Case("price", "<", 200, "Medium")), "High")
ORDER_RULE = Buckets((Case("total_amount", "<", 100, "Small"), Case("total_amount", "<", 500, "Medium")), "Large")
DOMAIN_RULE = RegexGroup("email", "@(.+)$", 1)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def instant(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def change_records(events: DataFrame, damaged: bool = False) -> DataFrame:
    """Kafka-shaped change records, one per event; ``damaged`` breaks some in each possible way."""
    at = F.col("ts").cast("timestamp")
    kind = F.col("event_type")
    op = F.when(kind == "signup", "c").when(kind == "error", "d").otherwise("u")
    k = F.get_json_object("props", "$.k").cast("bigint")
    image = F.struct(F.col("user_id").alias("id"), kind.alias("status"), F.col("value").alias("amount"), k.alias("k"))
    after = F.when(op != "d", image)
    before = F.when(op == "d", F.struct(F.col("user_id").alias("id")))
    name = F.lit("users")
    damage = F.col("event_id") % 50 if damaged else F.lit(0)
    if damaged:
        op = F.when(damage == 7, None).when(damage == 17, "x").otherwise(op)
        name = F.when(damage != 27, name)
        after, before = F.when(damage != 37, after), F.when(damage != 37, before)
    value = envelope_json(before, after, op, F.unix_millis(at), name, F.col("event_id"))
    return events.select(
        F.lit(TOPIC).alias("topic"),
        F.pmod("user_id", F.lit(3)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        at.alias("timestamp"),
        F.col("user_id").cast("string").alias("key"),
        (F.when(damage == 47, "not json").otherwise(value) if damaged else value).alias("value"),
    )


def ingest_clock() -> Column:
    """A repeatable stand-in for the ingest time: up to five seconds after the broker's."""
    return F.timestamp_millis(F.unix_millis("kafka_timestamp") + F.col("kafka_offset") % 5000)


def parsed_log(spark: SparkSession, folder: str, damaged: bool = False) -> DataFrame:
    return parse_envelope(change_records(spread(table(spark, folder, "events")), damaged), ingest_clock())


def decoded_log(spark: SparkSession, folder: str, spec: EntitySpec = STATUS) -> DataFrame:
    return decode_payload(parsed_log(spark, folder), spec)


def purchases(spark: SparkSession, folder: str) -> DataFrame:
    """Order facts: the purchase events."""
    bought = table(spark, folder, "events").where(F.col("event_type") == "purchase")
    return bought.select(
        F.col("event_id").alias("id"),
        "user_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("product_id"),
        F.lit(1).alias("quantity"),
        F.col("value").alias("total_amount"),
        F.lit("completed").alias("status"),
        F.col("ts").cast("timestamp").alias("_valid_from"),
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """Current user rows from ``customer``."""
    email = F.concat(F.lower("c_mktsegment"), F.col("c_custkey"), F.lit("@n"), F.col("c_nationkey"), F.lit(".example.com"))
    rows = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), email.alias("email")
    )
    return rows.withColumns({"email_domain": DOMAIN_RULE.build(), "_valid_from": instant("2024-01-01")})


def parts(spark: SparkSession, folder: str) -> DataFrame:
    """Current product rows from ``part``."""
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
    )


def order_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Order facts: one per row of ``orders``."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").alias("total_amount"),
        F.col("o_orderdate").cast("timestamp").alias("_valid_from"),
    )


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order facts: one per row of ``lineitem``, with buyer and date of its order."""
    lines = spread(table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice"))
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_extendedprice").alias("total_amount"),
        F.col("o_orderdate").cast("timestamp").alias("_valid_from"),
    )


def changed_customers(spark: SparkSession, folder: str) -> DataFrame:
    """A later snapshot of ``customer``: one segment gone, one nation's balances raised, suppliers added."""
    customer = table(spark, folder, "customer")
    kept = customer.where(F.col("c_mktsegment") != "FURNITURE")
    raised = F.when(F.col("c_nationkey") == 5, F.col("c_acctbal") + 1000).otherwise(F.col("c_acctbal"))
    added = table(spark, folder, "supplier").select(
        (F.col("s_suppkey") + 1_000_000_000_000).alias("c_custkey"),
        F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"),
        F.col("s_acctbal").alias("c_acctbal"),
        F.lit("SUPPLY").alias("c_mktsegment"),
    )
    return kept.withColumn("c_acctbal", raised).unionByName(added)


def status_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Connector status documents as a worker would report them: one per user, from its events."""
    events = table(spark, folder, "events")
    per_task = events.groupBy("user_id", "event_type").agg(F.max_by("value", "event_id").alias("value"))
    state = F.when(F.col("value") < 5, "FAILED").when(F.col("value") < 10, "PAUSED").otherwise("RUNNING")
    task = F.struct(F.col("event_type").alias("id"), state.alias("state"))
    per_user = per_task.groupBy("user_id").agg(
        F.sort_array(F.collect_list(task)).alias("tasks"),
        F.max(F.when(F.col("event_type") == "error", state)).alias("own"),
    )
    document = F.to_json(
        F.struct(F.struct(F.coalesce("own", F.lit("RUNNING")).alias("state")).alias("connector"), F.col("tasks"))
    )
    connector = F.concat(F.lit("connector-"), F.col("user_id"))
    return per_user.select(connector.alias("connector"), document.alias("status"))
