"""Change records from plain tables: an initial snapshot, or the difference of two snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEEP_NULLS = {"ignoreNullFields": "false"}


def envelope_json(
    before: Column | None,
    after: Column | None,
    op: Column,
    ts_ms: Column,
    table: Column,
    lsn: Column,
    tx_id: Column | None = None,
    db: str = "shop",
    schema: str = "public",
) -> Column:
    """A change-event envelope as JSON text; NULL fields are written out."""
    absent = F.lit(None).cast("bigint")
    source = F.struct(
        F.lit(db).alias("db"),
        F.lit(schema).alias("schema"),
        table.alias("table"),
        lsn.cast("bigint").alias("lsn"),
        (absent if tx_id is None else tx_id).alias("txId"),
    )
    missing = F.lit(None).cast("string")
    fields = F.struct(
        (missing if before is None else before).alias("before"),
        (missing if after is None else after).alias("after"),
        op.alias("op"),
        ts_ms.cast("bigint").alias("ts_ms"),
        source.alias("source"),
    )
    return F.to_json(fields, KEEP_NULLS)


def snapshot_to_events(rows: DataFrame, table: str, key: str, ts_ms: int, lsn: int = 0) -> DataFrame:
    """One read event (op ``r``) per existing row: ``key, value``."""
    value = envelope_json(None, F.struct(*rows.columns), F.lit("r"), F.lit(ts_ms), F.lit(table), F.lit(lsn))
    return rows.select(F.col(key).cast("string").alias("key"), value.alias("value"))


def diff_snapshots(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Create, update and delete events between two snapshots: ``key, op, before_json, after_json``.

    Columns of ``new`` are compared NULL-safely; unchanged rows give no event. ``key`` is unique
    in each snapshot, so the join has no skewed key.
    """
    columns: Sequence[str] = new.columns
    before = old.select(F.col(key), F.struct(*[F.col(c) for c in columns]).alias("before"))
    after = new.select(F.col(key), F.struct(*columns).alias("after"))
    op = (
        F.when(F.col("before").isNull(), "c")
        .when(F.col("after").isNull(), "d")
        .when(~F.col("before").eqNullSafe(F.col("after")), "u")
    )
    paired = before.join(after, key, "full_outer").withColumn("op", op).where(F.col("op").isNotNull())
    return paired.select(
        F.col(key).cast("string").alias("key"),
        "op",
        F.to_json("before", KEEP_NULLS).alias("before_json"),
        F.to_json("after", KEEP_NULLS).alias("after_json"),
    )
