"""Distinct customers that merge over days: bitmaps per day, united to any period exactly.

A count of distinct customers of a month is not the sum of its days'. Here a day keeps its customers as
bitmaps of 32,768 ids each (4 kB, only buckets that occur). Any period is the union of its days' bitmaps, so
old days are never read again as orders, and a day that changed is replaced alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolake.plans.marts import DAY


def customer_days(orders: DataFrame, *groups: str, customer: str = "user_id", order_time: str = "_valid_from") -> DataFrame:
    """Rows ``order_date``, the columns of ``groups``, ``bucket``, ``customers`` (a bitmap).

    Built on the map side first: a day with a third of all orders sends one bitmap for each bucket and task.
    Orders without a customer don't count.
    """
    known = orders.where(F.col(customer).isNotNull())
    placed = known.select(
        F.to_date(order_time).alias("order_date"),
        *groups,
        F.bitmap_bucket_number(F.col(customer).cast("bigint")).alias("bucket"),
        F.bitmap_bit_position(F.col(customer).cast("bigint")).alias("bit"),
    )
    return placed.groupBy("order_date", *groups, "bucket").agg(F.bitmap_construct_agg("bit").alias("customers"))


def distinct_customers(days: DataFrame, period: str, *groups: str) -> DataFrame:
    """Distinct customers by period (``day``, ``week`` from Monday, ``month``, ``quarter`` or ``year``).

    Returns ``period``, ``period_start`` (text), the columns of ``groups``, and ``unique_customers``.
    """
    start = F.date_format(F.date_trunc(period, F.col("order_date").cast("timestamp")), DAY)
    united = days.groupBy(start.alias("period_start"), *groups, "bucket").agg(F.bitmap_or_agg("customers").alias("customers"))
    counts = united.groupBy("period_start", *groups).agg(F.sum(F.bitmap_count("customers")).alias("unique_customers"))
    return counts.select(F.lit(period).alias("period"), "period_start", *groups, "unique_customers")
