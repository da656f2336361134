"""Number rows within groups although a group may hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronolake.session import stored


def numbered(rows: DataFrame, by: str, *order: str) -> DataFrame:
    """Add ``rank`` (long, from 1) within ``by`` in ``order``.

    The rows are range-sorted by (by, order) into pieces. Each piece counts its rows by group, the counts
    are summed over the pieces of a group (one row each), and rows are numbered within their piece only.
    """
    ascending = [F.col(c).asc() for c in (by, *order)]
    pieces = stored(rows.repartitionByRange(*ascending).withColumn("_part", F.spark_partition_id()), "pieces")
    along = Window.partitionBy("n_by").orderBy("n_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.groupBy(F.col(by).alias("n_by"), F.col("_part").alias("n_part")).agg(F.count(F.lit(1)).alias("n"))
    starts = starts.withColumn("before", F.coalesce(F.sum("n").over(along), F.lit(0)))
    inside = Window.partitionBy(by, "_part").orderBy(*order)
    placed = pieces.withColumn("_place", F.row_number().over(inside))
    same = F.col(by).eqNullSafe(F.col("n_by")) & (F.col("_part") == F.col("n_part"))
    placed = placed.join(starts, same).withColumn("rank", F.col("before") + F.col("_place"))
    return placed.select(*rows.columns, "rank")
