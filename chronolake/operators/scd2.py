"""One refinement step of a Type 2 history: open rows + a batch of latest events -> open and closed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronolake.functions.specs import AUDIT, CLOSE, KEY, ORDER, EntitySpec
from chronolake.operators.decode import with_row_hash

# What happens to a key. KEEP: not in the batch. SKIP: the batch event changes nothing.
KEEP, SKIP, TOUCH, INSERT, CLOSE_ROW, REPLACE = "KEEP", "SKIP", "TOUCH", "INSERT", "CLOSE", "CLOSE_AND_INSERT"

# A touched row stays the same version; only these advance.
_TOUCHED = (*[c for c in AUDIT if c != "operation"], "_cdc_order_lsn")


def _order(side: str) -> Column:
    """Order key as a struct: compares left to right, NULL lowest."""
    return F.struct(*[F.col(f"{side}.{c}") for c in ORDER])


def fences(closed: DataFrame) -> DataFrame:
    """Per key, the order key of the last event that closed it: ``id, fence``."""
    close = F.struct(*[F.col(c).alias(o) for c, o in zip(CLOSE, ORDER)])
    return closed.groupBy(KEY).agg(F.max(close).alias("fence"))


def advance_fences(known: DataFrame | None, batch: DataFrame) -> DataFrame:
    """Add the batch's deletes, matched or not, so that older events of those keys stay out."""
    deletes = batch.where(F.col("operation") == "d").select(KEY, F.struct(*ORDER).alias("fence"))
    both = deletes if known is None else known.select(KEY, "fence").unionByName(deletes)
    return both.groupBy(KEY).agg(F.max("fence").alias("fence"))


def plan_actions(
    open_rows: DataFrame, batch: DataFrame, spec: EntitySpec, known_fences: DataFrame | None = None
) -> DataFrame:
    """Pair each open row ``t`` with its batch event ``s`` and decide the action.

    Both sides hold a key once, so the join has no skewed key. The result has the columns
    ``id, t, s, action``; ``t`` or ``s`` is NULL where that side has no row.
    """
    staged = batch if "_hash" in batch.columns else with_row_hash(batch, spec)
    staged = staged.select(KEY, F.struct(*staged.columns).alias("s"))
    if known_fences is None:
        staged = staged.withColumn("fence", F.lit(None).cast(_fence_type()))
    else:
        staged = staged.join(known_fences.select(KEY, "fence"), KEY, "left")
    current = open_rows.select(KEY, F.struct(*spec.silver_types()).alias("t"))
    pairs = current.join(staged, KEY, "full_outer")

    is_delete = F.col("s.operation") == "d"
    newer = _order("s") > _order("t")
    action = (
        F.when(F.col("s").isNull(), KEEP)
        .when(F.col("t").isNull() & is_delete, SKIP)
        .when(F.col("t").isNull() & F.col("fence").isNotNull() & (_order("s") <= F.col("fence")), SKIP)
        .when(F.col("t").isNull(), INSERT)
        .when(~newer, SKIP)
        .when(is_delete, CLOSE_ROW)
        .when(F.col("s._hash") == F.col("t._hash"), TOUCH)
        .otherwise(REPLACE)
    )
    return pairs.withColumn("action", action).select(KEY, "t", "s", "action")


def _fence_type() -> str:
    return "struct<" + ",".join(f"{c}:bigint" for c in ORDER) + ">"


def apply_actions(planned: DataFrame, spec: EntitySpec, effective_at: Column) -> DataFrame:
    """The rows after the step: all open rows, and the rows this step closed."""
    emitted = planned.withColumn(
        "_row",
        F.explode(
            F.when(F.col("action") == REPLACE, F.array(F.lit("closed"), F.lit("new")))
            .when(F.col("action") == CLOSE_ROW, F.array(F.lit("closed")))
            .when(F.col("action") == INSERT, F.array(F.lit("new")))
            .when(F.col("t").isNotNull(), F.array(F.lit("open")))
            .otherwise(F.array().cast("array<string>"))
        ),
    )
    is_new, is_closed = F.col("_row") == "new", F.col("_row") == "closed"
    touched = F.col("action") == TOUCH

    def column(name: str, type_name: str) -> Column:
        old = F.col(f"t.{name}")
        if name == "_valid_from":
            value = F.when(is_new, effective_at).otherwise(old)
        elif name == "_valid_to":
            value = F.when(is_closed, effective_at)
        elif name == "_is_current":
            value = ~is_closed
        elif name in CLOSE:
            value = F.when(is_closed, F.col(f"s.{ORDER[CLOSE.index(name)]}"))
        elif name == "is_active":
            value = F.when(is_new, F.lit(True)).otherwise(old & (F.col("action") != CLOSE_ROW))
        elif name in _TOUCHED:
            event = F.col("s.pg_lsn") if name == "_cdc_order_lsn" else F.col(f"s.{name}")
            value = F.when(is_new | touched, event).otherwise(old)
        else:
            value = F.when(is_new, F.col(f"s.{name}")).otherwise(old)
        return value.cast(type_name).alias(name)

    return emitted.select(*[column(name, type_name) for name, type_name in spec.silver_types().items()])


def apply_scd2(
    open_rows: DataFrame,
    batch: DataFrame,
    spec: EntitySpec,
    effective_at: Column,
    known_fences: DataFrame | None = None,
) -> DataFrame:
    """Plan and apply in one plan: close, replace, insert and touch with one validity stamp."""
    return apply_actions(plan_actions(open_rows, batch, spec, known_fences), spec, effective_at)


def unseen_rows(batch: DataFrame, open_rows: DataFrame, spec: EntitySpec) -> DataFrame:
    """Live batch rows whose content is not the open row of their key: what a step would bring in.

    Deletes have no open row to look for. After the step only events are left that it skipped as older
    than the row, or the delete, that it found.
    """
    staged = batch if "_hash" in batch.columns else with_row_hash(batch, spec)
    staged = staged.where(F.col("operation") != "d")
    return staged.join(open_rows.select(KEY, "_hash"), [KEY, "_hash"], "left_anti")


def empty_silver(spark, spec: EntitySpec) -> DataFrame:
    ddl = ", ".join(f"`{name}` {type_name}" for name, type_name in spec.silver_types().items())
    return spark.createDataFrame([], ddl)


def merge_staging(planned: DataFrame, spec: EntitySpec, effective_at: Column) -> DataFrame:
    """Planned actions as the source of ``merge_statement``: ``_merge_key``, ``_action``, the new row's columns.

    A replaced row needs two source rows: one with its key, which closes the old version, and one without,
    which inserts the new one. Skipped and untouched keys are left out.
    """
    parts = F.when(F.col("action") == REPLACE, F.array(F.lit(CLOSE_ROW), F.lit(INSERT)))
    acting = planned.where(F.col("action").isin(TOUCH, INSERT, CLOSE_ROW, REPLACE))
    acting = acting.withColumn("_action", F.explode(parts.otherwise(F.array("action"))))
    values = {
        "_valid_from": effective_at,
        "_valid_to": F.lit(None),
        "_is_current": F.lit(True),
        "is_active": F.col("s.operation") != "d",
        "_cdc_order_lsn": F.col("s.pg_lsn"),
        **{c: F.col(f"s.{o}") for c, o in zip(CLOSE, ORDER)},
    }
    return acting.select(
        F.when(F.col("_action") != INSERT, F.col(KEY)).alias("_merge_key"),
        "_action",
        *[values.get(c, F.col(f"s.{c}")).cast(t).alias(c) for c, t in spec.silver_types().items()],
    )


def merge_statement(target: str, staging: str, spec: EntitySpec) -> str:
    """The step as MERGE text, for catalogs whose tables support MERGE; ``staging`` holds ``merge_staging``.

    All rules are decided by ``plan_actions`` before: the text only carries the actions out.
    """
    columns = [c for c in spec.silver_types() if c not in CLOSE]
    names = ", ".join(f"`{c}`" for c in columns)
    values = ", ".join(f"s.`{c}`" for c in columns)
    closing = ", ".join(f"t.{c} = s.{c}" for c in CLOSE)
    touching = ", ".join(f"t.`{c}` = s.`{c}`" for c in _TOUCHED)
    return f"""MERGE INTO {target} AS t USING {staging} AS s
ON t.{KEY} = s._merge_key AND t._is_current
WHEN MATCHED AND s._action = '{TOUCH}' THEN
  UPDATE SET {touching}
WHEN MATCHED AND s._action = '{CLOSE_ROW}' THEN
  UPDATE SET t.is_active = t.is_active AND s.is_active, t._valid_to = s._valid_from, t._is_current = false, {closing}
WHEN NOT MATCHED AND s._action = '{INSERT}' THEN
  INSERT ({names}) VALUES ({values})"""
