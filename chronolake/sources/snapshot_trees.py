"""Snapshots with a tree of range hashes: a difference reads only the ranges that changed.

A snapshot is stored in ranges of its key, with two levels of hashes: one for each range, and one for each
group of ranges. Two snapshots are compared from the top: groups with equal hashes are left out, then ranges
with equal hashes, and only the rows of the others are read and joined. What a difference costs follows the
ranges that changed; the hashes of a table are about a millionth of it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolake.sources.snapshots import diff_snapshots

WIDTH = 100_000  # keys of a range
FAN = 256  # ranges of a group
MAX_LISTED = 1_000  # ranges that a filter names; more are joined

_HASHES = "rows bigint, total decimal(38,0), mark bigint"


@dataclass(frozen=True)
class SnapshotTree:
    """A stored snapshot: ``rows`` by range, ``ranges`` and ``groups`` with their hashes."""

    folder: str

    def rows(self, spark: SparkSession) -> DataFrame:
        schema = spark.read.parquet(f"{self.folder}/columns").schema  # an empty snapshot has no other file
        schema = schema.add("_group", "long").add("_range", "long")
        return spark.read.schema(schema).parquet(f"{self.folder}/rows")

    def ranges(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(f"_range bigint, {_HASHES}, _group bigint").parquet(f"{self.folder}/ranges")

    def groups(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(f"_group bigint, {_HASHES}").parquet(f"{self.folder}/groups")


def _row_hashes(columns: list[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row; a null differs from a missing neighbour."""
    parts = [c for name in columns for c in (F.col(f"`{name}`").isNull(), F.col(f"`{name}`"))]
    return F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(2), *parts)


def write_snapshot(rows: DataFrame, key: str, folder: str, width: int = WIDTH, fan: int = FAN) -> SnapshotTree:
    """Store a snapshot in a new folder. ``key`` is an integral, unique column; compare equal widths only.

    The hashes of a range are a sum and an exclusive or, so they don't depend on the order of rows and are
    combined before the shuffle.
    """
    columns = rows.columns
    place = F.floor(F.col(f"`{key}`") / F.lit(width)).cast("bigint")
    placed = rows.withColumns({"_range": place, "_group": F.floor(place / F.lit(fan)).cast("bigint")})
    ordered = placed.repartitionByRange(F.col(f"`{key}`").asc()).sortWithinPartitions(key)
    ordered.write.partitionBy("_group", "_range").parquet(f"{folder}/rows")
    rows.limit(0).write.parquet(f"{folder}/columns")
    tree = SnapshotTree(folder)
    one, two = _row_hashes(columns)
    sums = [F.sum("rows").alias("rows"), F.sum("total").alias("total"), F.bit_xor("mark").alias("mark")]
    leaves = placed.select("_group", "_range", F.lit(1).cast("bigint").alias("rows"), one.cast("decimal(38,0)").alias("total"), two.alias("mark"))
    shaped = [F.col(c).cast(t).alias(c) for c, t in (x.split() for x in _HASHES.split(", "))]
    leaves = leaves.groupBy("_group", "_range").agg(*sums).select("_range", *shaped, "_group")
    leaves.write.partitionBy("_group").parquet(f"{folder}/ranges")
    groups = tree.ranges(rows.sparkSession).groupBy("_group").agg(*sums).select("_group", *shaped)
    groups.write.parquet(f"{folder}/groups")
    return tree


def _unequal(old: DataFrame, new: DataFrame, place: str) -> DataFrame:
    """Places whose hashes differ, or that only one side has; rows without a key have the place null."""
    left = old.select(F.col(place).alias("p"), F.struct("rows", "total", "mark").alias("old"))
    right = new.select(F.col(place).alias("q"), F.struct("rows", "total", "mark").alias("new"))
    paired = left.join(right, F.col("p").eqNullSafe(F.col("q")), "full_outer")
    return paired.where(~F.col("old").eqNullSafe(F.col("new"))).select(F.coalesce("p", "q").alias(place))


def _within(rows: DataFrame, places: DataFrame, place: str) -> DataFrame:
    """The rows of these places: named in the filter where they are few, so that partitions are left out."""
    few = [r[0] for r in places.limit(MAX_LISTED + 1).collect()]
    if len(few) > MAX_LISTED:
        return rows.join(places.select(F.col(place).alias("_p")), F.col(place).eqNullSafe(F.col("_p")), "left_semi")
    named = F.col(place).isin([p for p in few if p is not None])
    return rows.where(named | F.col(place).isNull() if None in few else named)


def changed_ranges(old: SnapshotTree, new: SnapshotTree, spark: SparkSession) -> DataFrame:
    """Rows ``_range``: the ranges whose rows differ. Range hashes are read for unequal groups only."""
    groups = _unequal(old.groups(spark), new.groups(spark), "_group")
    return _unequal(*[_within(tree.ranges(spark), groups, "_group") for tree in (old, new)], "_range")


def diff_trees(old: SnapshotTree, new: SnapshotTree, key: str, spark: SparkSession) -> DataFrame:
    """``diff_snapshots`` of two stored snapshots, over the changed ranges only."""
    ranges = changed_ranges(old, new, spark)
    before, after = [_within(tree.rows(spark), ranges, "_range").drop("_range", "_group") for tree in (old, new)]
    return diff_snapshots(before, after, key)
