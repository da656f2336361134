"""The jobs' command lines, run in this session."""

import pytest

from chronolake.jobs import ingest, publish, refine
from shop import Feed, write_records


def test_three_jobs_in_turn(spark, tmp_path):
    feed = Feed()
    snapshot = [feed.record("users", "r", {"id": 50, "name": "Old", "email": "old@s.org"})]
    write_records(tmp_path / "in", "1.json", feed.seeds() + snapshot)
    paths = ["--log", f"{tmp_path}/log", "--dead-letters", f"{tmp_path}/dead", "--checkpoint", f"{tmp_path}/c"]
    ingest.main(["--files", f"{tmp_path}/in", "--available-now", "--snapshot-ops", "r", *paths])
    refine.main(["--database", "job_shop", "--log", f"{tmp_path}/log", "--buckets", "4"])
    publish.main(["--database", "job_shop"])
    assert spark.table("job_shop.gold_user_analytics").count() == 6
    assert spark.table("job_shop.gold_sales_summary").first()["total_revenue"] == 4539.86

    write_records(tmp_path / "in", "2.json", [feed.record("orders", "c", {"id": 11, "user_id": 50, "product_id": 1, "quantity": 1, "total_amount": 1001, "status": "new"})])
    ingest.main(["--files", f"{tmp_path}/in", "--available-now", "--snapshot-ops", "r", *paths])
    refine.main(["--database", "job_shop", "--log", f"{tmp_path}/log", "--buckets", "4", "--entities", "orders"])
    for _ in range(3):
        publish.main(["--database", "job_shop"])
    row = spark.table("job_shop.gold_user_analytics").where("user_id = 50").first()
    assert (row["total_orders"], row["total_spent"], row["segment"]) == (1, 1001.0, "VIP")
    kept = [t.name for t in spark.catalog.listTables("job_shop") if t.name.startswith("gold_user_analytics_v")]
    assert sorted(kept) == ["gold_user_analytics_v3", "gold_user_analytics_v4"]


def test_source_is_required(tmp_path):
    with pytest.raises(SystemExit):
        ingest.main(["--log", "x", "--dead-letters", "y", "--checkpoint", "z"])
