"""Marts kept up by changes equal the marts built from all orders, after every step."""

import datetime
import random

from pyspark.sql import functions as F

from chronolake.jobs.publish import publish_all, publish_changes
from chronolake.functions.specs import ORDERS, PRODUCTS, USERS
from chronolake.plans.increments import OrderTotals
from chronolake.plans.marts import daily_sales, product_analytics, user_analytics
from chronolake.warehouse import SilverTable, ensure_database

SCHEMA = "id bigint, user_id bigint, product_id bigint, total_amount double, _valid_from timestamp"
START = datetime.datetime(2024, 1, 1)


def rows_of(frame):
    return sorted(map(str, frame.collect()))


def test_totals_equal_the_full_marts_after_every_step(spark, tmp_path):
    today, stamp = F.lit("2024-02-10").cast("date"), F.lit("2024-02-11").cast("timestamp")
    draw = random.Random(8)
    ids = [1, 2, 3, 4, None]
    users = spark.createDataFrame([(i, f"u{i}", "d", START) for i in range(1, 6)], "id bigint, name string, email_domain string, _valid_from timestamp")
    products = spark.createDataFrame([(i, f"p{i}", "c", 1.0) for i in range(1, 6)], "id bigint, name string, category string, price double")
    totals, current = OrderTotals(str(tmp_path / "totals")), {}
    totals.create(spark)

    def order(i):
        amount = draw.choice([10.0, 20.25, 3000.0, None, float("nan")])
        return (i, draw.choice(ids), draw.choice(ids), amount, START + datetime.timedelta(hours=draw.randrange(40 * 24)))

    for step in range(3):
        opened, closed = [], []
        for i in draw.sample(range(60), 25):
            if i in current:
                closed.append(current.pop(i))
            if draw.random() < 0.6:
                current[i] = order(i)
                opened.append(current[i])
        frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
        orders = frame(list(current.values()))
        totals.advance(frame(opened), frame(closed), orders)
        if step == 1:
            assert totals.fold(spark, 1)
        assert rows_of(totals.user_analytics(users, today, refreshed_at=stamp)) == rows_of(user_analytics(users, orders, today, refreshed_at=stamp))
        assert rows_of(totals.product_analytics(products, today, refreshed_at=stamp)) == rows_of(product_analytics(products, orders, today, refreshed_at=stamp))
        assert rows_of(totals.daily_sales(spark, stamp)) == rows_of(daily_sales(orders, refreshed_at=stamp))
    # A step writes the changed keys only, and a repeated attempt at a step changes nothing.
    one = [(99, 4, 4, 1.0, START)]
    totals.advance(spark.createDataFrame(one, SCHEMA), spark.createDataFrame([], SCHEMA), spark.createDataFrame([*current.values(), *one], SCHEMA))
    step, _ = totals.committed(spark)
    for name in ("users", "product_days", "product_users", "day_users"):
        assert spark.read.parquet(f"{totals.folder}/{name}/step={step}").count() == 1


def test_publish_by_changes_of_the_silver_tables(spark, tmp_path):
    from shop import Feed
    from test_silver_deltas import new_table

    database = "shop_by_changes"
    new_table(spark, database)
    ensure_database(spark, database)
    tables = {spec.name: SilverTable(database, spec, 2) for spec in (USERS, PRODUCTS, ORDERS)}

    def refine(changes, batch):
        from chronolake.operators.envelope import parse_envelope

        records = [(0, batch * 1000 + i, str(r)) for i, r in enumerate(changes)]
        raw = spark.createDataFrame(records, "partition int, offset bigint, value string")
        raw = raw.withColumns({"topic": F.lit("t"), "timestamp": F.lit(START), "key": F.lit("k")})
        log = parse_envelope(raw).withColumn("_batch_id", F.lit(batch).cast("bigint"))
        for table in tables.values():
            table.refine(log)

    feed = Feed()
    value = lambda r: r["value"] if isinstance(r, dict) and "value" in r else r
    refine([value(r) for r in feed.seeds()], 0)
    assert compare_marts(spark, database, tmp_path)
    refine([value(feed.record("orders", "d", None, {"id": 1})), value(feed.record("orders", "c", {"id": 50, "user_id": 3, "product_id": 2, "total_amount": 7.5}))], 1)
    assert compare_marts(spark, database, tmp_path)
    assert OrderTotals(str(tmp_path / "t")).committed(spark) == (2, 1)  # by changes, not anew
    for batch in (2, 3):
        refine([value(feed.record("orders", "u", {"id": 50, "user_id": 3, "product_id": 2, "total_amount": 8.5 + batch}))], batch)
        tables["orders"].fold(spark, 0)
    assert compare_marts(spark, database, tmp_path)  # a run was folded away: from all orders again
    assert OrderTotals(str(tmp_path / "t")).committed(spark) == (3, 3)


def compare_marts(spark, database, tmp_path):
    marts = ("gold_user_analytics", "gold_product_analytics", "gold_sales_summary")
    publish_changes(spark, database, str(tmp_path / "t"))
    by_changes = [rows_of(spark.table(f"{database}.{m}").drop("refresh_date")) for m in marts]
    publish_all(spark, database)
    return by_changes == [rows_of(spark.table(f"{database}.{m}").drop("refresh_date")) for m in marts]
