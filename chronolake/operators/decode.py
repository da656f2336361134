"""From raw-log rows of one entity to typed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronolake.functions.hashing import content_hash
from chronolake.functions.specs import AUDIT, KEY, ORDER, EntitySpec


def decode_payload(events: DataFrame, spec: EntitySpec) -> DataFrame:
    """Typed source columns, derived columns, live flag and audit columns.

    A delete is read from its before-image, every other event from its after-image. The schema is
    the declared one: unknown fields are ignored, missing or unreadable ones are NULL.
    """
    is_delete = F.col("operation") == "d"
    image = F.when(is_delete, F.col("before_json")).otherwise(F.col("after_json"))
    typed = (
        events.select("*", F.explode_outer(F.array(F.from_json(image, spec.payload_schema()))).alias("_payload"))
        .withColumn("is_active", F.when(is_delete, False).otherwise(True))
        .select(*spec.typed("_payload"), "is_active", *AUDIT)
    )
    derived = spec.derived()
    return (typed.withColumns(derived) if derived else typed).select(*spec.business(), *AUDIT)


def latest_per_key(rows: DataFrame, key: str = KEY, order: Sequence[str] = ORDER) -> DataFrame:
    """The last row of each key. Catalyst limits each key before the shuffle, so a hot key
    sends one row per map task, however many it has."""
    newest_first = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
    ranked = rows.withColumn("_rank", F.row_number().over(newest_first))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def with_row_hash(rows: DataFrame, spec: EntitySpec, length_prefixed: bool = False) -> DataFrame:
    return rows.withColumn("_hash", content_hash(spec.business(), length_prefixed))
