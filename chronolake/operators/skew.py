"""Ordered per-key work that stays balanced when single keys hold a large share of all rows.

A plain window puts a whole key into one task. Here keys above ``max_rows`` are found first (a
map-side combined count), and only their rows are cut into contiguous, evenly filled segments by
a range partitioning on (key, order) into as many tasks as the rows need, each cut into runs of at most
``max_rows``. Work then runs per segment, and only segment borders meet in
one task: at most two rows per segment.

Rows of one key that agree in the order (copies of one event, facts of one instant) may be cut
apart, too. The partition they were read from breaks the tie: unlike a random number it is the same
when a lost task runs again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from chronolake.session import shared_folder

# Rows of one key that one task may sort on its own.
MAX_ROWS_PER_KEY = 2_000_000

# Hot rows that one task sorts, when many keys are hot.
_ROWS_PER_TASK = 1_000_000

# Hot keys that may be broadcast. There are at most total rows / MAX_ROWS_PER_KEY of them.
_MAX_BROADCAST_KEYS = 1_000_000

SEGMENT = "_segment"


@dataclass(frozen=True)
class Balanced:
    """``cold`` rows fit a plain window per key; ``hot`` rows (None without hot keys) carry SEGMENT."""

    cold: DataFrame
    hot: DataFrame | None


def balance(rows: DataFrame, key: str, order: Sequence[str], max_rows: int = MAX_ROWS_PER_KEY) -> Balanced:
    """Split rows by the load of their key. Runs one counting job over the key column."""
    spark = rows.sparkSession
    shared_folder(spark)
    hot_keys = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > max_rows)
    hot_keys = hot_keys.checkpoint()
    load = hot_keys.agg(F.count(F.lit(1)).alias("keys"), F.sum("_rows").alias("rows")).first()
    if load["keys"] == 0:
        return Balanced(rows, None)
    names = hot_keys.select(F.col(key).alias("_hot_key"))
    is_hot = F.col(key).eqNullSafe(F.col("_hot_key"))  # rows without a key can be many, too
    if load["keys"] <= _MAX_BROADCAST_KEYS:
        names = F.broadcast(names)
    segments = max(2, -(-load["rows"] // max_rows))
    tasks = min(segments, max(spark.sparkContext.defaultParallelism, -(-load["rows"] // _ROWS_PER_TASK)))
    ordered = [F.col(c).asc() for c in (key, *order, "_tie")]
    # A segment is a run of at most max_rows rows in a task's sorted range, not a task of its own: the
    # number of tasks follows the rows, not the rows over max_rows. Numbers rise along (key, order).
    seq = F.monotonically_increasing_id()
    place = F.col("_seq").bitwiseAND(F.lit((1 << 33) - 1))
    hot = (
        rows.withColumn("_tie", F.spark_partition_id())
        .join(names, is_hot, "left_semi")
        .repartitionByRange(tasks, *ordered)
        .sortWithinPartitions(*ordered)
        .withColumn("_seq", seq)
        .withColumn(SEGMENT, F.col("_seq") - place + F.floor(place / F.lit(max_rows)).cast("long"))
        .drop("_tie", "_seq")
    )
    return Balanced(rows.join(names, is_hot, "left_anti"), hot)


def with_neighbours(
    rows: DataFrame,
    key: str,
    order: Sequence[str],
    previous: Mapping[str, str] | None = None,
    following: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add values of the row before and after, per key in ``order``.

    ``previous`` and ``following`` map new column names to the columns they read. Rows with a
    SEGMENT column are handled per segment; border rows then look across borders among themselves.
    """
    previous, following = dict(previous or {}), dict(following or {})

    def look(window: WindowSpec) -> dict[str, Column]:
        columns = {new: F.lag(old).over(window) for new, old in previous.items()}
        columns.update({new: F.lead(old).over(window) for new, old in following.items()})
        return columns

    ascending = [F.col(c).asc() for c in order]
    if SEGMENT not in rows.columns:
        return rows.withColumns(look(Window.partitionBy(key).orderBy(*ascending)))

    inside = Window.partitionBy(key, SEGMENT).orderBy(*ascending)
    rows = rows.withColumns(
        {
            **look(inside),
            "_first": F.lag(F.lit(True)).over(inside).isNull(),
            "_last": F.lead(F.lit(True)).over(inside).isNull(),
        }
    )
    group = F.when(F.col("_first") | F.col("_last"), F.lit(-1)).otherwise(F.col(SEGMENT))
    # Segments follow each other in order, so their numbers sort the border rows, ties included.
    across = Window.partitionBy(key, "_group").orderBy(SEGMENT, "_last")
    rows = rows.withColumn("_group", group).withColumns({f"_across_{new}": c for new, c in look(across).items()})
    fixed = {new: F.when(F.col("_first"), F.col(f"_across_{new}")).otherwise(F.col(new)) for new in previous}
    fixed.update({new: F.when(F.col("_last"), F.col(f"_across_{new}")).otherwise(F.col(new)) for new in following})
    helpers = ["_first", "_last", "_group", *[f"_across_{new}" for new in fixed]]
    return rows.withColumns(fixed).drop(*helpers)
