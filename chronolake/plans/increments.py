"""Marts kept up by changes: totals that take orders back as well as add them.

Four keyed tables hold what the marts are made of: totals of users, totals of (day, product), and how many
orders each (product, user) and (day, user) has. A step takes the versions of orders that were closed (minus)
and opened (plus), sums them by key on the map side, and writes the changed keys only; the newest row of a key
counts, and a key without orders left is gone. Sums can be taken back. A latest order can't: it is read again
from the orders, for those users only that lost theirs.

Nothing but the changed keys' rows of the state is combined, and nothing else is written. ``fold`` writes a
table anew once it has gathered many steps.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronolake.plans.marts import RECENT_DAYS, Segments, Tiers, by_revenue, cents, daily_mart, product_mart, user_mart
from chronolake.session import stored

TABLES = {
    "users": ("user_id",),
    "product_days": ("order_date", "product_id"),
    "product_users": ("product_id", "user_id"),
    "day_users": ("order_date", "user_id"),
}

# Orders, those with an amount, those with a sound one, and its cents.
SUMS = ("orders", "priced", "valued", "cents")

FOLD_AFTER = 16


def _measured(orders: DataFrame, sign: int, order_time: str) -> DataFrame:
    value = cents("total_amount")
    one = F.lit(sign).cast("bigint")
    return orders.select(
        F.col("user_id").cast("bigint").alias("user_id"),
        F.col("product_id").cast("bigint").alias("product_id"),
        F.to_date(order_time).alias("order_date"),
        F.col(order_time).cast("timestamp").alias("at"),
        F.lit(sign).alias("sign"),
        one.alias("orders"),
        F.when(F.col("total_amount").isNotNull(), one).otherwise(0).alias("priced"),
        F.when(value.isNotNull(), one).otherwise(0).alias("valued"),
        F.coalesce(value * one, F.lit(0)).alias("cents"),
    )


def _same(left: str, right: str, keys: tuple[str, ...]) -> Column:
    conditions = [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]
    return conditions[0] if len(conditions) == 1 else conditions[0] & conditions[1]


@dataclass(frozen=True)
class OrderTotals:
    """The four tables in a folder that all executors share; one writer at a time.

    A step is committed by its row in ``commits``, written last. Leftovers of a step that died are
    overwritten by the next attempt.
    """

    folder: str

    def _path(self, name: str, step: int | None = None) -> str:
        path = f"{self.folder.rstrip('/')}/{name}"
        return path if step is None else f"{path}/step={step}"

    def create(self, spark: SparkSession) -> None:
        """An empty state, as step 0."""
        self._commit(spark, 0, 0)

    def exists(self, spark: SparkSession) -> bool:
        folder = spark._jvm.org.apache.hadoop.fs.Path(self._path("commits"))
        return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)

    def committed(self, spark: SparkSession) -> tuple[int, int]:
        """Last step, and the step of the last fold."""
        row = self._last_commit(spark)
        return row["step"], row["since"]

    def mark(self, spark: SparkSession) -> int | None:
        """What the caller kept with the last step, such as the run of the orders that it has seen."""
        return self._last_commit(spark)["mark"]

    def _last_commit(self, spark: SparkSession):
        commits = spark.read.schema("step int, since int, mark bigint").option("recursiveFileLookup", "true")
        return commits.parquet(self._path("commits")).agg(F.max(F.struct("step", "since", "mark"))).first()[0]

    def _commit(self, spark: SparkSession, step: int, since: int, mark: int | None = None) -> None:
        row = spark.range(1).select(F.lit(step).alias("step"), F.lit(since).alias("since"), F.lit(mark).cast("bigint").alias("mark"))
        row.write.mode("overwrite").parquet(f"{self._path('commits')}/{step}")

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        """Current rows of a table: its keys and sums, and ``last_at`` for users."""
        return self._read(spark, name, *self.committed(spark))

    def _read(self, spark: SparkSession, name: str, step: int, since: int) -> DataFrame:
        keys = TABLES[name]
        types = {"order_date": "date", "user_id": "bigint", "product_id": "bigint"}
        columns = {**{k: types[k] for k in keys}, **{s: "bigint" for s in SUMS}, **({"last_at": "timestamp"} if name == "users" else {})}
        steps = list(range(max(1, since), step + 1))
        ddl = ", ".join(f"{c} {t}" for c, t in columns.items())
        if not steps:
            return spark.createDataFrame([], ddl)
        rows = spark.read.schema(f"{ddl}, step int").option("basePath", self._path(name))
        rows = rows.parquet(*[self._path(name, s) for s in steps])
        newest = Window.partitionBy(*keys).orderBy(F.col("step").desc())
        ranked = rows.withColumn("_rank", F.row_number().over(newest))
        return ranked.where((F.col("_rank") == 1) & (F.col("orders") > 0)).select(*columns)

    def advance(
        self, opened: DataFrame, closed: DataFrame, orders: DataFrame, order_time: str = "_valid_from", mark: int | None = None
    ) -> int:
        """Add the opened versions of orders, take back the closed ones; returns the step.

        ``orders`` are all current orders after the change: read for users whose latest order was taken back.
        """
        step, since = self.committed(opened.sparkSession)
        return self._advance(opened, closed, orders, order_time, step, since, mark)

    def restart(self, orders: DataFrame, order_time: str = "_valid_from", mark: int | None = None) -> int:
        """Start again from all current orders, as one step that nothing before it counts for."""
        step, _ = self.committed(orders.sparkSession)
        return self._advance(orders, orders.limit(0), orders, order_time, step, step + 1, mark)

    def _advance(self, opened, closed, orders, order_time, step: int, since: int, mark: int | None) -> int:
        spark = opened.sparkSession
        changes = _measured(opened, 1, order_time).unionByName(_measured(closed, -1, order_time))
        changes = stored(changes, "order-changes")
        for name, keys in TABLES.items():
            rows = changes if name in ("users", "product_days") else changes.where(F.col("user_id").isNotNull())
            sums = [F.sum(s).alias(s) for s in SUMS]
            if name == "users":
                sums += [F.max(F.when(F.col("sign") == s, F.col("at"))).alias(n) for s, n in ((1, "plus"), (-1, "minus"))]
            delta = stored(rows.groupBy(*keys).agg(*sums), f"delta-{name}")
            old = self._read(spark, name, step, since).alias("old").join(delta.alias("new"), _same("old", "new", keys), "left_semi")
            if name == "users":
                changed = self._latest(old, delta, orders, order_time)
            else:
                changed = old.unionByName(delta).groupBy(*keys).agg(*[F.sum(s).alias(s) for s in SUMS])
            changed.write.mode("overwrite").parquet(self._path(name, step + 1))
        self._commit(spark, step + 1, since, mark)
        return step + 1

    def _latest(self, old: DataFrame, delta: DataFrame, orders: DataFrame, order_time: str) -> DataFrame:
        none = F.lit(None).cast("timestamp")
        both = old.withColumns({"plus": none, "minus": none}).unionByName(delta.withColumn("last_at", none))
        both = both.groupBy("user_id").agg(*[F.sum(s).alias(s) for s in SUMS], *[F.max(c).alias(c) for c in ("last_at", "plus", "minus")])
        # Lost: the latest order was taken back, and none as late was added.
        lost = (F.col("minus") >= F.col("last_at")) & (F.col("plus").isNull() | (F.col("plus") < F.col("minus")))
        both = both.withColumn("lost", F.coalesce(lost, F.lit(False)) & (F.col("orders") > 0))
        both = stored(both, "changed-users")
        losers = both.where("lost").select("user_id")
        mine = orders.select(F.col("user_id").cast("bigint").alias("user_id"), F.col(order_time).cast("timestamp").alias("at"))
        mine = mine.alias("o").join(losers.alias("l"), F.col("o.user_id").eqNullSafe(F.col("l.user_id")), "left_semi")
        again = mine.groupBy("user_id").agg(F.max("at").alias("again"))
        joined = both.alias("b").join(again.alias("a"), F.col("b.user_id").eqNullSafe(F.col("a.user_id")), "left")
        last = F.when(F.col("lost"), F.col("again")).otherwise(F.greatest("last_at", "plus"))
        return joined.select("b.user_id", *SUMS, last.alias("last_at"))

    def fold(self, spark: SparkSession, after: int = FOLD_AFTER) -> bool:
        """Write the tables anew as one step, if more than ``after`` steps have gathered since the last time."""
        step, since = self.committed(spark)
        if step - since <= after:
            return False
        for name in TABLES:
            self.read(spark, name).write.mode("overwrite").parquet(self._path(name, step + 1))
        self._commit(spark, step + 1, step + 1, self.mark(spark))
        return True

    # --- marts from the state ---

    def user_analytics(self, users: DataFrame, as_of: Column, segments: Segments = Segments(), refreshed_at: Column | None = None) -> DataFrame:
        stats = self.read(users.sparkSession, "users").select(
            "user_id",
            F.col("orders").alias("order_count"),
            F.when(F.col("valued") > 0, F.col("cents")).alias("spent_cents"),
            F.nullif("priced", F.lit(0)).alias("priced_orders"),
            F.col("last_at").alias("last_order_date"),
        )
        return user_mart(users, stats, as_of, segments, refreshed_at)

    def product_analytics(self, products: DataFrame, as_of: Column, tiers: Tiers = Tiers(), refreshed_at: Column | None = None) -> DataFrame:
        spark = products.sparkSession
        recent = F.col("order_date") >= F.date_sub(as_of, RECENT_DAYS)
        totals = self.read(spark, "product_days").groupBy("product_id").agg(
            F.sum("orders").alias("order_count"),
            F.sum("cents").alias("revenue_cents"),
            F.sum(F.when(recent, F.col("cents"))).alias("recent_cents"),
        )
        customers = self.read(spark, "product_users").groupBy(F.col("product_id").alias("c_product"))
        customers = customers.agg(F.count(F.lit(1)).alias("customers"))
        stats = totals.join(customers, totals["product_id"] == customers["c_product"], "left").drop("c_product")
        return product_mart(products, stats, tiers, refreshed_at)

    def daily_sales(self, spark: SparkSession, refreshed_at: Column | None = None) -> DataFrame:
        products = self.read(spark, "product_days").withColumn("revenue_cents", F.when(F.col("valued") > 0, F.col("cents")))
        days = products.groupBy("order_date").agg(
            F.sum("orders").alias("total_orders"),
            F.sum("revenue_cents").alias("revenue_cents"),
            F.nullif(F.sum("priced"), F.lit(0)).alias("priced_orders"),
            F.max_by("product_id", by_revenue()).alias("top_product_id"),
        )
        users = self.read(spark, "day_users").groupBy(F.col("order_date").alias("u_date"))
        users = users.agg(F.count(F.lit(1)).alias("unique_customers"))
        joined = days.join(users, F.col("order_date").eqNullSafe(F.col("u_date")), "left").drop("u_date")
        return daily_mart(joined.withColumn("unique_customers", F.coalesce("unique_customers", F.lit(0))), refreshed_at)
