"""Quality job: checks of the history tables, between refining and publishing, as one report table."""

from __future__ import annotations

import argparse
import logging
import sys
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolake.functions.specs import ENTITIES, KEY
from chronolake.operators.history import current_rows
from chronolake.operators.quality import duplicate_keys, history_violations, null_counts, orphans
from chronolake.session import build_session
from chronolake.warehouse import exists, publish

logger = logging.getLogger("chronolake.check")

# References between the source tables (child table and column, parent table).
REFERENCES = (("orders", "user_id", "users"), ("orders", "product_id", "products"))

REPORT = {"table_name": "string", "check_name": "string", "subject": "string", "found": "bigint"}

# Checks whose findings are errors; NULLs are counted for information.
STRICT = ("duplicate_keys", "history_rules", "orphans")


def _findings(rows: DataFrame, table: str, check: str, subject, found) -> DataFrame:
    name = F.lit(subject) if isinstance(subject, str) else subject
    return rows.select(
        F.lit(table).alias("table_name"),
        F.lit(check).alias("check_name"),
        name.alias("subject"),
        found.cast("bigint").alias("found"),
    )


def report(spark: SparkSession, database: str) -> DataFrame | None:
    """One row for each check of each existing table, with 0 where nothing was found."""
    histories = {
        name: spark.table(f"{database}.silver_{name}")
        for name in ENTITIES
        if exists(spark, f"{database}.silver_{name}")
    }
    parts: list[DataFrame] = []
    for name, history in histories.items():
        rows, count = current_rows(history), F.count(F.lit(1))
        nulls = null_counts(rows, list(ENTITIES[name].columns))
        parts.append(_findings(nulls, name, "nulls", F.col("column_name"), F.col("null_rows")))
        parts.append(_findings(duplicate_keys(rows, [KEY]).agg(count.alias("n")), name, "duplicate_keys", KEY, F.col("n")))
        broken = history_violations(history).agg(count.alias("n"))
        parts.append(_findings(broken, name, "history_rules", KEY, F.col("n")))
    for child, column, parent in REFERENCES:
        if child in histories and parent in histories:
            parents = current_rows(histories[parent]).select(F.col(KEY).alias("parent_id"))
            lost = orphans(current_rows(histories[child]), parents, {column: "parent_id"})
            lost = lost.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("n"))
            parts.append(_findings(lost, child, "orphans", column, F.col("n")))
    return reduce(DataFrame.unionByName, parts) if parts else None


def check_all(spark: SparkSession, database: str) -> dict[tuple[str, str, str], int]:
    """Publish the report as ``quality_report`` and return what strict checks found (the report has few rows)."""
    rows = report(spark, database)
    if rows is None:
        logger.warning("no history tables in %s", database)
        return {}
    name = f"{database}.quality_report"
    publish(rows, name, REPORT)
    bad = spark.table(name).where(F.col("check_name").isin(*STRICT) & (F.col("found") > 0))
    return {(r["table_name"], r["check_name"], r["subject"]): r["found"] for r in bad.collect()}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--database", required=True)
    parser.add_argument("--fail", action="store_true", help="end with an error if a strict check found something")
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    found = check_all(build_session("chronolake-check"), args.database)
    for (table, check, subject), n in found.items():
        logger.warning("%s.%s: %s found %d", table, subject, check, n)
    if found and args.fail:
        sys.exit(1)


if __name__ == "__main__":
    main()
