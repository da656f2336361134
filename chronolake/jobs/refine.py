"""Refinement job: raw log -> Type 2 history tables of all entities."""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from chronolake.functions.specs import ENTITIES
from chronolake.session import build_session
from chronolake.warehouse import BUCKETS, FOLD_AFTER, SilverTable, ensure_database, ensure_log_table, exists, recover

logger = logging.getLogger("chronolake.refine")


def refine_all(
    spark: SparkSession,
    database: str,
    log_table: str,
    entities: list[str] | None = None,
    buckets: int = BUCKETS,
    fold_after: int = FOLD_AFTER,
    rebuild: bool = False,
) -> dict[str, dict[str, int] | None]:
    """Refine each entity in turn; the first failure ends the run. None: nothing new.

    ``rebuild`` replaces the tables by the complete history in the log. Slices of a table that have gathered
    more than ``fold_after`` runs are folded.
    """
    ensure_database(spark, database)
    if not exists(spark, log_table):
        logger.warning("no raw log %s", log_table)
        return {}
    log = spark.read.table(log_table)
    results = {}
    for name in entities or list(ENTITIES):
        table = SilverTable(database, ENTITIES[name], buckets)
        results[name] = table.rebuild(log) if rebuild else table.refine(log)
        table.fold(spark, fold_after)
        logger.info("%s: %s", name, results[name] or "nothing new")
    return results


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--database", required=True)
    parser.add_argument("--log", required=True, help="folder the ingest job writes")
    parser.add_argument("--entities", nargs="*", choices=list(ENTITIES))
    parser.add_argument("--buckets", type=int, default=BUCKETS)
    parser.add_argument("--fold-after", type=int, default=FOLD_AFTER, help="runs a part of a table gathers before it is folded")
    parser.add_argument("--rebuild", action="store_true", help="replace the tables by the complete history in the log")
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    spark = build_session("chronolake-refine")
    ensure_database(spark, args.database)
    log_table = f"{args.database}.bronze_cdc_events"
    ensure_log_table(spark, log_table, args.log)
    recover(spark, log_table)
    refine_all(spark, args.database, log_table, args.entities, args.buckets, args.fold_after, args.rebuild)


if __name__ == "__main__":
    main()
