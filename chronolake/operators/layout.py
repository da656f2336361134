"""Clustering of stored rows: files that hold small boxes of several columns at once (Z-order).

Each column is put into quantile steps, so that skewed values spread evenly, and the bits of the steps are
interleaved. Rows sorted by that number and cut into files have narrow ranges in every column, and the minima
and maxima that Parquet keeps for each row group let point and range reads skip most files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 8  # of each column: 256 steps
FILE_BYTES = 128 << 20


def quantile_step(column: Column, bounds: Sequence) -> Column:
    """Number of bounds at or below the value, by halving; null is step 0."""

    def below(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(column >= F.lit(bounds[middle]), below(middle + 1, high)).otherwise(below(low, middle))

    return F.when(column.isNull(), F.lit(0)).otherwise(below(0, len(bounds)))


def interleaved(steps: Sequence[Column], bits: int = BITS) -> Column:
    """The bits of the steps in turn, from the highest on, as one bigint."""
    if bits * len(steps) > 62:
        raise ValueError("the bits don't fit a bigint")
    total = F.lit(0).cast("bigint")
    for bit in range(bits):
        for place, step in enumerate(steps):
            own = F.shiftright(step, bit).bitwiseAND(F.lit(1)).cast("bigint")
            total = total + F.shiftleft(own, bit * len(steps) + len(steps) - 1 - place)
    return total


def _bytes(rows: DataFrame) -> Column:
    """About the size of the rows: the bytes of strings and binaries, eight for any other value."""
    sizes = [
        F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) if f.dataType.typeName() in ("string", "binary") else F.lit(8)
        for f in rows.schema
    ]
    return F.sum(sum(sizes[1:], sizes[0]) if sizes else F.lit(0)).cast("bigint")


def clustered(rows: DataFrame, by: Sequence[str], files: int, bits: int = BITS, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Rows dealt into ranges of their Z-order over the numeric columns ``by``, sorted within.

    ``files`` ranges at least, and as many more as keep a range near ``file_bytes``, so that the task that
    sorts and writes one holds a bounded share of the rows however large they grow. The quantiles and the
    size are approximate (one pass, some hundred numbers for each column reach the driver). Rows of one box
    can be cut apart at any of the columns, so a frequent value doesn't fill one file.
    """
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = rows.agg(*[F.percentile_approx(c, F.lit(shares), 10_000).alias(c) for c in by], _bytes(rows).alias("_bytes")).first()
    steps = [quantile_step(F.col(c), sorted(set(found[c] or []))) for c in by]
    ranges = max(files, -(-(found["_bytes"] or 0) // file_bytes))
    order = ["_z", *by]
    placed = rows.withColumn("_z", interleaved(steps, bits))
    return placed.repartitionByRange(ranges, *order).sortWithinPartitions(*order).drop("_z")
