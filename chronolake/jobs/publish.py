"""Mart job: current rows -> customer, product and daily-sales marts."""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolake.functions.specs import ENTITIES
from chronolake.operators.history import current_rows
from chronolake.plans.increments import OrderTotals
from chronolake.plans.marts import daily_sales, product_analytics, user_analytics
from chronolake.session import build_session
from chronolake.warehouse import MARTS, SilverTable, exists, publish

logger = logging.getLogger("chronolake.publish")


def publish_all(spark: SparkSession, database: str) -> dict[str, int | None]:
    """Rows per mart; None where an input table is missing and the mart was left as it is."""

    def current(name: str) -> DataFrame:
        return current_rows(spark.read.table(f"{database}.silver_{name}"))

    builds = {
        "gold_user_analytics": (("users", "orders"), user_analytics),
        "gold_product_analytics": (("products", "orders"), product_analytics),
        "gold_sales_summary": (("orders",), daily_sales),
    }
    counts: dict[str, int | None] = {}
    for mart, (inputs, build) in builds.items():
        missing = [name for name in inputs if not exists(spark, f"{database}.silver_{name}")]
        if missing:
            logger.warning("%s skipped, missing: %s", mart, ", ".join(missing))
            counts[mart] = None
            continue
        counts[mart] = publish(build(*[current(name) for name in inputs]), f"{database}.{mart}", MARTS[mart])
        logger.info("%s: %d rows", mart, counts[mart])
    return counts


def publish_changes(spark: SparkSession, database: str, folder: str) -> dict[str, int]:
    """The same marts from totals in ``folder``, brought up to date by what changed in the orders since."""
    totals, silver = OrderTotals(folder), SilverTable(database, ENTITIES["orders"])
    users, products, orders = (current_rows(spark.read.table(f"{database}.silver_{n}")) for n in ("users", "products", "orders"))
    if not totals.exists(spark):
        totals.create(spark)
    run, mark = silver.committed_run(spark), totals.mark(spark)
    changes = None if mark is None else silver.changes(spark, mark)
    if changes is None:  # a first time, or runs were folded away before they were seen
        totals.restart(orders, mark=run)
    elif run > mark:
        totals.advance(*changes, orders, mark=run)
        totals.fold(spark)
    today = F.current_date()
    marts = {
        "gold_user_analytics": totals.user_analytics(users, today),
        "gold_product_analytics": totals.product_analytics(products, today),
        "gold_sales_summary": totals.daily_sales(spark),
    }
    return {name: publish(rows, f"{database}.{name}", MARTS[name]) for name, rows in marts.items()}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--database", required=True)
    parser.add_argument("--totals", help="folder of the totals that keep the marts up by changes; without it they are built anew")
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    spark = build_session("chronolake-publish")
    if args.totals:
        publish_changes(spark, args.database, args.totals)
    else:
        publish_all(spark, args.database)


if __name__ == "__main__":
    main()
