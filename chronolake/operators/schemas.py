"""Schema evolution: fields that row images hold, how they change, and entities that follow."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronolake.functions.specs import AUDIT_TYPES, HISTORY_TYPES, KEY, EntitySpec
from chronolake.operators.decode import with_row_hash

# Fields of one entity, as a row each in the registry. More than these are no schema but data in field names.
MAX_FIELDS = 2000

REGISTRY = "source_table string, field string, kind string"

UNTYPED = "void"  # a field that has been null in all images


def observed_fields(events: DataFrame) -> DataFrame:
    """(source_table, field, kind, row_count) of the events' after-images; ``kind`` holds all of a field's values.

    Kinds are ``boolean``, ``bigint``, ``double``, ``string`` (also for objects, lists and mixed values, as their
    text) and ``void``. Images that are no JSON object have no fields. Types are merged before the
    shuffle: a task sends one row for each field of each entity.
    """
    images = events.where((F.col("operation") != "d") & F.col("source_table").isNotNull())
    images = images.select("source_table", F.try_parse_json("after_json").alias("image"))
    exploded = images.lateralJoin(images.sparkSession.tvf.variant_explode(F.col("image").outer()))
    fields = exploded.where(F.col("key").isNotNull()).groupBy("source_table", F.col("key").alias("field"))
    merged = fields.agg(F.schema_of_variant_agg("value").alias("_type"), F.count(F.lit(1)).alias("row_count"))
    return merged.select("source_table", "field", _kind(F.col("_type")).alias("kind"), "row_count")


def _kind(variant_type: Column) -> Column:
    number = variant_type.startswith("DECIMAL") | variant_type.isin("DOUBLE", "FLOAT")
    plain = F.when(variant_type.isin("VOID", "BOOLEAN", "BIGINT"), F.lower(variant_type))
    return F.coalesce(plain, F.when(number, F.lit("double")), F.lit("string"))


def wider(a: Column, b: Column) -> Column:
    """The kind that holds the values of both."""
    numbers = a.isin("bigint", "double") & b.isin("bigint", "double")
    one = F.when((a == b) | (b == UNTYPED), a).when(a == UNTYPED, b)
    return one.when(numbers, F.lit("double")).otherwise(F.lit("string"))


def schema_changes(known: DataFrame, observed: DataFrame) -> DataFrame:
    """The registry against what a batch holds: one row for each field of either.

    ``change`` is ``added``, ``widened``, ``dropped`` (the batch has images of the entity, none with the field) or
    ``unchanged``. Kinds never become narrower, and dropped fields stay with theirs.
    """
    old = known.select("source_table", "field", F.col("kind").alias("old_kind"))
    new = observed.select("source_table", "field", F.col("kind").alias("_seen"), "row_count")
    entities = observed.select("source_table").distinct().withColumn("_present", F.lit(True))
    both = old.join(new, ["source_table", "field"], "full").join(entities, "source_table", "left")
    before, seen = F.col("old_kind"), F.col("_seen")
    new_kind = F.when(before.isNull(), seen).when(seen.isNull(), before).otherwise(wider(before, seen))
    both = both.withColumn("new_kind", new_kind)
    change = (
        F.when(F.col("old_kind").isNull(), "added")
        .when(F.col("_seen").isNull() & F.col("_present"), "dropped")
        .when(F.col("old_kind") != F.col("new_kind"), "widened")
        .otherwise("unchanged")
    )
    count = F.coalesce("row_count", F.lit(0)).alias("row_count")
    return both.select("source_table", "field", change.alias("change"), "old_kind", "new_kind", count)


def advanced(changes: DataFrame) -> DataFrame:
    """The next registry."""
    return changes.select("source_table", "field", F.col("new_kind").alias("kind"))


def evolved(spec: EntitySpec, registry: DataFrame) -> EntitySpec:
    """The entity with the registry's new fields as columns, and with its plain columns widened.

    The key and encoded columns keep their types, as do declared types that aren't kinds. Fields without a type yet,
    and fields whose name, read in any case, is a column of the entity or of its tables, are left out.
    """
    rows = registry.where(F.col("source_table") == spec.name).limit(MAX_FIELDS + 1).collect()
    if len(rows) > MAX_FIELDS:
        raise ValueError(f"entity {spec.name!r} has more than {MAX_FIELDS} fields: keep them in one column")
    kinds = {r["field"]: r["kind"] for r in rows if r["kind"] != UNTYPED}
    fixed = {KEY, *spec.decimals, *spec.micros}
    columns = {c: t if c in fixed else _widened(t, kinds.get(c, t)) for c, t in spec.columns.items()}
    taken = {c.lower() for c in (*columns, *spec.rules, "is_active", *AUDIT_TYPES, *HISTORY_TYPES)}
    for field in sorted(kinds):
        if field.lower() not in taken:
            columns[field] = kinds[field]
            taken.add(field.lower())
    return replace(spec, columns=columns)


def _widened(declared: str, kind: str) -> str:
    if declared == kind or {declared, kind} - {"boolean", "bigint", "double", "string"}:
        return declared
    return "double" if {declared, kind} == {"bigint", "double"} else "string"


def widened_rows(silver: DataFrame, spec: EntitySpec) -> DataFrame:
    """Rows of a silver table in the layout of an evolved entity: new columns are NULL, content is hashed anew.

    A later event that holds a value in a new column is a change of content, one that holds none isn't.
    """
    types = spec.silver_types()
    rows = silver.select(*[(F.col(c) if c in silver.columns else F.lit(None)).cast(t).alias(c) for c, t in types.items()])
    # The hash is that of the opening event, which was live.
    live = rows.withColumn("_live", F.col("is_active")).withColumn("is_active", F.lit(True)).drop("_hash")
    hashed = with_row_hash(live, spec).withColumn("is_active", F.col("_live"))
    return hashed.select(*types)
