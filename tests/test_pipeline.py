"""Records in files -> raw log -> history tables -> marts, twice, through the jobs' own code."""

import json

import pytest

from chronolake.functions.specs import ORDERS, USERS
from chronolake.jobs import ingest, refine
from chronolake.jobs.publish import publish_all
from chronolake.jobs.refine import refine_all
from chronolake.sources.files import read_record_files
from chronolake.streaming.ingest import start_split_ingest
from chronolake.warehouse import SilverTable, ensure_database, ensure_log_table, recover
from shop import START_MS, Feed, write_records


class Shop:
    def __init__(self, spark, folder, database):
        self.spark, self.folder, self.database = spark, folder, database
        self.log = f"{database}.bronze_cdc_events"

    def ingest(self):
        query = start_split_ingest(
            read_record_files(self.spark, str(self.folder / "in")),
            str(self.folder / "log"),
            str(self.folder / "dead"),
            str(self.folder / "checkpoint"),
            interval=None,
        )
        query.awaitTermination()
        ensure_database(self.spark, self.database)
        ensure_log_table(self.spark, self.log, str(self.folder / "log"))
        recover(self.spark, self.log)

    def refine(self):
        return refine_all(self.spark, self.database, self.log, buckets=8)

    def rows(self, query):
        return [tuple(r) for r in self.spark.sql(query.format(db=self.database)).collect()]


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    shop = Shop(spark, tmp_path_factory.mktemp("shop"), "shop_pipeline")
    shop.feed = Feed()
    write_records(shop.folder / "in", "1.json", shop.feed.seeds() + [shop.feed.raw("not json")])
    shop.ingest()
    shop.first = shop.refine()
    return shop


def test_first_run_opens_every_row(shop):
    assert {name: r["open"] for name, r in shop.first.items()} == {"users": 5, "products": 8, "orders": 10}
    domains = shop.rows("SELECT email_domain FROM {db}.silver_users WHERE _is_current ORDER BY id")
    assert [d for (d,) in domains] == ["example.com", "company.com", "test.org", "demo.com", "sample.com"]
    prices = shop.rows("SELECT price_category FROM {db}.silver_products WHERE _is_current ORDER BY id")
    assert [p for (p,) in prices] == ["High", "Low", "Medium", "High", "Medium", "High", "Medium", "Medium"]
    values = shop.rows("SELECT order_value_category FROM {db}.silver_orders WHERE _is_current ORDER BY id")
    assert [v for (v,) in values] == [
        "Large", "Small", "Medium", "Medium", "Medium", "Medium", "Medium", "Small", "Medium", "Large",
    ]


def test_dead_letters_are_written(shop, spark):
    dead = spark.read.json(str(shop.folder / "dead"))
    assert [r["error_type"] for r in dead.collect()] == ["NULL_OPERATION"]


def test_marts_match_the_seed_totals(shop):
    assert publish_all(shop.spark, shop.database) == {
        "gold_user_analytics": 5,
        "gold_product_analytics": 8,
        "gold_sales_summary": 1,
    }
    users = shop.rows("SELECT user_id, total_orders, total_spent, segment FROM {db}.gold_user_analytics ORDER BY 1")
    assert users == [
        (1, 3, 1559.96, "VIP"),
        (2, 3, 1949.97, "VIP"),
        (3, 2, 639.96, "Loyal"),
        (4, 1, 299.98, "New"),
        (5, 1, 89.99, "New"),
    ]
    products = shop.rows(
        "SELECT product_id, total_orders, total_revenue, unique_customers, performance_tier "
        "FROM {db}.gold_product_analytics ORDER BY 1 LIMIT 3"
    )
    assert products == [(1, 2, 2599.98, 2, "Average"), (2, 1, 59.98, 1, "Low"), (3, 2, 399.98, 2, "Low")]
    day = shop.rows(
        "SELECT total_orders, total_revenue, round(avg_order_value, 3), unique_customers, top_product_id "
        "FROM {db}.gold_sales_summary"
    )
    assert day == [(10, 4539.86, 453.986, 5, 1)]


def test_replay_changes_nothing_then_changes_are_versioned(shop):
    before = shop.rows("SELECT id, _valid_from, _is_current FROM {db}.silver_users ORDER BY 1, 2")
    shop.refine()
    assert shop.rows("SELECT id, _valid_from, _is_current FROM {db}.silver_users ORDER BY 1, 2") == before

    feed = shop.feed
    changes = [
        feed.record("users", "u", {"id": 1, "name": "John Doe", "email": "john@new.example"}),
        feed.record("users", "d", None, {"id": 2}),
        feed.record("users", "d", None, {"id": 99}),
        feed.record("users", "c", {"id": 6, "name": "Fay", "email": "fay@six.org"}),
        feed.record("users", "u", {"id": 99, "name": "Late", "email": "late@late.org"}, lsn=5, ts_ms=1_704_067_201_500),
    ]
    write_records(shop.folder / "in", "2.json", changes)
    shop.ingest()
    assert shop.refine()["users"]["closed"] == 2
    state = shop.rows(
        "SELECT id, email_domain, is_active, _is_current, _valid_to IS NULL FROM {db}.silver_users "
        "WHERE id IN (1, 2, 6, 99) ORDER BY id, _valid_from"
    )
    assert state == [
        (1, "example.com", True, False, False),
        (1, "new.example", True, True, True),
        (2, "company.com", False, False, False),
        (6, "six.org", True, True, True),
    ]
    ends = shop.rows("SELECT max(_valid_to) = max(_valid_from) FROM {db}.silver_users WHERE id = 1")
    assert ends == [(True,)]

    shop.refine()
    assert shop.rows("SELECT count(*) FROM {db}.silver_users") == [(7,)]


def test_the_committed_watermark_is_the_newest_time_in_the_table(shop, spark):
    for name in ("users", "products", "orders"):
        kept = dict(spark.sql(f"SHOW TBLPROPERTIES {shop.database}.silver_{name}").collect())["chronolake.watermark"]
        assert shop.rows(f"SELECT max(source_ts_ms) FROM {{db}}.silver_{name}") == [(int(kept),)]


def test_leftovers_of_a_dead_run_stay_invisible(shop, spark):
    table = SilverTable(shop.database, USERS, 8)
    shown = shop.rows("SELECT count(*), count_if(_is_current) FROM {db}.silver_users")
    run = int(dict(spark.sql(f"SHOW TBLPROPERTIES {table.view}").collect())["chronolake.run"])
    stray = spark.table(table.versions).where(f"_run_id = {run}").selectExpr(
        *[f"{run + 1}L AS _run_id" if c == "_run_id" else c for c in spark.table(table.versions).columns]
    )
    stray.write.insertInto(table.versions)
    assert shop.rows("SELECT count(*), count_if(_is_current) FROM {db}.silver_users") == shown
    shop.refine()
    assert shop.rows("SELECT count(*), count_if(_is_current) FROM {db}.silver_users") == shown


def test_merge_keeps_the_stored_layout_of_open_rows(spark, shop):
    from chronolake.operators.scd2 import plan_actions

    table = SilverTable(shop.database, ORDERS, 8)
    run = int(dict(spark.sql(f"SHOW TBLPROPERTIES {table.view}").collect())["chronolake.run"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        staged = spark.table(table.staging).drop("_run_id")
        plan = plan_actions(table.open_rows(spark, run), staged, ORDERS)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan
    assert "Exchange" not in plan, plan


def test_marts_without_inputs_are_skipped(spark):
    ensure_database(spark, "shop_empty")
    assert set(publish_all(spark, "shop_empty").values()) == {None}


def test_every_event_is_refined_whatever_its_time(spark, tmp_path):
    """Late by days, undated, absurdly dated, then normal again: every id ends in silver, each read once."""
    feed = Feed()
    hour = 3_600_000
    steps = [
        [feed.record("users", "c", {"id": 1, "name": "a", "email": "a@x.y"}, ts_ms=START_MS + 100 * hour)],
        [feed.record("users", "c", {"id": 2, "name": "b", "email": "b@x.y"}, ts_ms=START_MS + 2 * hour)],
        [json.loads(json.dumps(feed.record("users", "c", {"id": 3, "name": "c", "email": "c@x.y"})).replace(
            f'\\"ts_ms\\": {START_MS + 3000}', '\\"ts_ms\\": null'))],
        [feed.record("users", "c", {"id": 4, "name": "d", "email": "d@x.y"}, ts_ms=START_MS * 1000)],
        [feed.record("users", "c", {"id": 5, "name": "e", "email": "e@x.y"}, ts_ms=START_MS + 101 * hour)],
    ]
    paths = ["--log", f"{tmp_path}/log", "--dead-letters", f"{tmp_path}/dead", "--checkpoint", f"{tmp_path}/c"]
    for number, records in enumerate(steps):
        write_records(tmp_path / "in", f"{number}.json", records)
        ingest.main(["--files", f"{tmp_path}/in", "--available-now", "--max-files", "3", *paths])
        refine.main(["--database", "late_shop", "--log", f"{tmp_path}/log", "--buckets", "2", "--entities", "users"])
    assert [r.id for r in spark.table("late_shop.silver_users").orderBy("id").collect()] == [1, 2, 3, 4, 5]
    table = SilverTable("late_shop", USERS, 2)
    assert table.refine(spark.table("late_shop.bronze_cdc_events")) is None


def test_both_log_layouts_can_be_refined(spark, tmp_path):
    """The plain log writer has no batch folders; a table of the wrong layout is an error, not empty."""
    from chronolake.operators.envelope import good_events, parse_envelope, classify
    from chronolake.sources.files import read_record_files
    from chronolake.streaming.ingest import start_log_writer
    from chronolake.warehouse import ensure_log_table, recover

    feed, log = Feed(), f"{tmp_path}/log"
    for number, offset in enumerate((0, 1)):
        write_records(tmp_path / "in", f"{number}.json", [feed.record("users", "c", {"id": offset, "name": "n", "email": "e@x.y"})])
        good = good_events(classify(parse_envelope(read_record_files(spark, f"{tmp_path}/in"))))
        start_log_writer(good, log, f"{tmp_path}/c", interval=None).awaitTermination()
        ensure_database(spark, "plain_shop")
        ensure_log_table(spark, "plain_shop.log", log)
        recover(spark, "plain_shop.log")
        assert SilverTable("plain_shop", USERS, 2).refine(spark.table("plain_shop.log"))["staged"] == 1
    assert spark.table("plain_shop.silver_users").count() == 2
    wrong = f"{tmp_path}/other"
    spark.range(1).selectExpr("'users' AS source_table", "current_date() AS ingest_date", "0L AS _batch_id", "'t' AS topic").write.partitionBy(
        "source_table", "ingest_date", "_batch_id"
    ).parquet(wrong)
    with pytest.raises(ValueError):
        ensure_log_table(spark, "plain_shop.log", wrong)


def test_quality_job_reports_and_fails(spark, shop):
    from chronolake.jobs import check

    lost = ("orders", "orphans", "user_id")
    before = check.check_all(spark, shop.database).get(lost, 0)  # orders of users that were deleted
    found = {(r.table_name, r.check_name, r.subject): r.found for r in spark.table(f"{shop.database}.quality_report").collect()}
    assert found["users", "nulls", "created_at"] > 0 and found[lost] == before
    write_records(shop.folder / "in", "9.json", [shop.feed.record("orders", "c", {"id": 77, "user_id": 1234, "product_id": 1})])
    shop.ingest()
    shop.refine()
    assert check.check_all(spark, shop.database) == {lost: before + 1}
    with pytest.raises(SystemExit):
        check.main(["--database", shop.database, "--fail"])
    assert check.check_all(spark, "no_such_shop") == {}
