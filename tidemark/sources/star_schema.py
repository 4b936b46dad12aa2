"""Customer, order, monthly and product tables derived from a star schema.

The star schema has orders, order lines, parts, customers and nations. Everything the retention
operators need is derived with joins and aggregates; the few attributes a star schema does not
hold (age, device, reviews, ...) are arithmetic on the customer key.

History is what happened before ``snapshot``; the label says whether the customer came back
within ``horizon_days`` after it, so no feature sees the label period.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.numeric import mean, rows, total
from tidemark.session import settle

SNAPSHOT = dt.date(2000, 8, 1)
HORIZON_DAYS = 365

PART_DERIVED = frozenset({"product_name", "category"})
LINE_DERIVED = frozenset({"returns_made", "preferred_category"})
LINE_COLUMNS = (
    "order_id", "customer_id", "product_id", "product_name", "category", "order_status", "order_date", "delivery_date",
    "delivery_days", "customer_rating", "discount_pct", "returned", "total_amount_usd", "session_duration_minutes",
    "pages_viewed_before_purchase",
)


# Column types of the star-schema tables.
SOURCES = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string",
}


class StarSchema:
    """Lazy access to the derived tables of one star-schema folder."""

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        snapshot: dt.date = SNAPSHOT,
        horizon_days: int = HORIZON_DAYS,
    ):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.snapshot = snapshot
        self.horizon_days = horizon_days
        self._lines: DataFrame | None = None

    def source(self, name: str) -> DataFrame:
        return self.spark.read.schema(SOURCES[name]).parquet(f"{self.folder}/{name}.parquet")

    @property
    def _cutoff(self) -> Column:
        return F.lit(self.snapshot)

    @cached_property
    def _past_orders(self) -> DataFrame:
        # The timestamp bound reaches the Parquet scan; a cast on the column would not.
        bound = F.lit(dt.datetime.combine(self.snapshot, dt.time())).cast("timestamp_ntz")
        return self.source("orders").where(F.col("o_orderdate") < bound)

    def orders(self, *wanted: str) -> DataFrame:
        """One row per order line placed before the snapshot.

        Naming the wanted columns leaves the parts out where no part column is among them: every
        line refers to a part, so the join changes no row. Columns that ``store_lines`` holds come from there.
        """
        by_part = not wanted or bool(PART_DERIVED & set(wanted))
        if self._lines is not None and {*wanted, *(() if wanted else LINE_COLUMNS)} <= set(self._lines.columns):
            kept = F.col("_part").isNotNull() if by_part else F.coalesce(F.col("_part"), F.lit(1)) == 1
            return self._lines.where(kept).select(*(wanted or LINE_COLUMNS))
        joined = self._joined_lines()
        if by_part:
            parts = self.source("part").select("p_partkey", "p_name", "p_type")
            joined = joined.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        columns = self._line_columns()
        return joined.select(*[columns[name].alias(name) for name in wanted or columns])

    def store_lines(self, *wanted: str) -> None:
        """Join the order lines once and store them, for reports that read them several times.

        ``orders`` then reads the copy. ``_part`` numbers the parts that a line refers to (null: none), so that the
        copy gives the same rows as the joins, with and without part columns, whatever the part keys are.
        """
        wanted = wanted or LINE_COLUMNS
        if self._lines is not None and set(wanted) <= set(self._lines.columns):
            return
        parts = self.source("part").select("p_partkey", "p_name", "p_type").where("p_partkey is not null")
        parts = parts.withColumn("_part", F.row_number().over(W.partitionBy("p_partkey").orderBy("p_type", "p_name")))
        joined = self._joined_lines().join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
        columns = self._line_columns()
        self._lines = settle(joined.select(*[columns[name].alias(name) for name in wanted], "_part"), "lines", "zstd")

    def _joined_lines(self) -> DataFrame:
        heads = self._past_orders.select(
            "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("_d")
        )
        return self.source("lineitem").join(heads, F.col("l_orderkey") == F.col("o_orderkey"))

    def _line_columns(self) -> dict[str, Column]:
        ship = F.col("l_shipdate").cast("date")
        delivered = F.when(ship >= F.col("_d"), ship)
        price = F.col("l_extendedprice").cast("decimal(12,2)")
        discount = F.col("l_discount").cast("decimal(4,2)")
        rated = F.col("l_orderkey") % 8 < 3
        return {
            "order_id": F.col("l_orderkey") * 10 + F.col("l_linenumber"),
            "customer_id": F.col("o_custkey"),
            "product_id": F.col("l_partkey"),
            "product_name": F.col("p_name"),
            "category": F.col("p_type"),
            "order_status": F.col("o_orderstatus"),
            "order_date": F.col("_d"),
            "delivery_date": delivered,
            "delivery_days": F.datediff(delivered, F.col("_d")),
            "customer_rating": F.when(rated, (1 + F.col("l_orderkey") % 5).cast("double")),
            "discount_pct": F.round(F.col("l_discount") * 100).cast("int"),
            "returned": (F.col("l_returnflag") == "R").cast("int"),
            "total_amount_usd": (price * (1 - discount)).cast("decimal(18,4)"),
            "session_duration_minutes": F.col("l_quantity"),
            "pages_viewed_before_purchase": F.col("l_linenumber"),
        }

    def _order_history(self, with_priority: bool) -> DataFrame:
        """Per customer, from order heads: history measures and the label's later orders.

        For the usual priority, orders are counted per (customer, priority) first: the same pass
        then gives all measures.
        """
        start = dt.datetime.combine(self.snapshot, dt.time())
        end = F.lit(start + dt.timedelta(days=self.horizon_days)).cast("timestamp_ntz")
        past = F.col("o_orderdate") < F.lit(start).cast("timestamp_ntz")
        day = F.col("o_orderdate").cast("date")
        orders = self.source("orders").where(F.col("o_orderdate") < end)
        measures = [
            F.count_if(past).alias("n_past"),
            F.count_if(~past).alias("n_later"),
            F.sum(F.when(past, F.col("o_totalprice").cast("decimal(14,2)"))).alias("spend"),
            F.min(F.when(past, day)).alias("first_day"),
            F.max(F.when(past, day)).alias("last_day"),
        ]
        key = F.col("o_custkey").alias("h_custkey")
        if not with_priority:
            return orders.groupBy(key).agg(*measures)
        per_priority = orders.groupBy("o_custkey", "o_orderpriority").agg(*measures)
        return per_priority.groupBy(key).agg(
            *[F.sum(c).alias(c) for c in ("n_past", "n_later", "spend")],
            F.min("first_day").alias("first_day"),
            F.max("last_day").alias("last_day"),
            _most_frequent("o_orderpriority", "n_past").alias("usual_priority"),
        )

    def _line_history(self) -> DataFrame:
        """Per customer, from order lines: returns and the most bought category."""
        per_category = (
            self.orders("customer_id", "category", "returned")
            .groupBy("customer_id", "category")
            .agg(rows().alias("n"), F.sum("returned").alias("returns"))
        )
        return per_category.groupBy(F.col("customer_id").alias("l_custkey")).agg(
            F.sum("returns").alias("returns"),
            _most_frequent("category", "n").alias("usual_category"),
        )

    def customers(self, *wanted: str) -> DataFrame:
        """One row per customer. Naming the wanted columns avoids joining order lines for nothing."""
        with_priority = not wanted or "preferred_payment_method" in wanted
        history = self._order_history(with_priority)
        base = (
            self.source("customer")
            .join(self.source("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .join(history, F.col("c_custkey") == F.col("h_custkey"), "left")
        )
        key = F.col("c_custkey")
        balance = F.col("c_acctbal")
        n_past = F.coalesce(F.col("n_past"), F.lit(0))
        spend = F.coalesce(F.col("spend"), F.lit(0)).cast("decimal(24,2)")
        columns = {
            "customer_id": key,
            "registration_date": F.col("first_day"),
            "age": (18 + key % 63).cast("int"),
            "gender": F.when(key % 3 == 0, " female").when(key % 3 == 1, "MALE ").otherwise("other"),
            "country": F.col("n_name"),
            "membership_tier": F.when(balance < 4000, "Free")
            .when(balance < 6500, "Silver")
            .when(balance < 8500, "Gold")
            .otherwise("Platinum"),
            "preferred_device": F.when((key * 7) % 3 == 0, "mobile")
            .when((key * 7) % 3 == 1, "desktop")
            .otherwise("tablet"),
            "acquisition_channel": F.col("c_mktsegment"),
            "total_orders": n_past.cast("int"),
            "total_spend_usd": spend,
            "avg_order_value_usd": spend.cast("double") / F.greatest(n_past, F.lit(1)),
            "days_since_last_purchase": F.datediff(self._cutoff, F.col("last_day")),
            "reviews_given": (key % 5).cast("int"),
            "avg_review_score": 1 + ((key * 13) % 41).cast("double") / 10.0,
            "wishlist_items": ((key * 11) % 21).cast("int"),
            "newsletter_subscribed": (key % 2).cast("int"),
            "churned": (F.coalesce(F.col("n_later"), F.lit(0)) == 0).cast("int"),
        }
        if with_priority:
            columns["preferred_payment_method"] = F.col("usual_priority")
        if not wanted or LINE_DERIVED & set(wanted):
            base = base.join(self._line_history(), key == F.col("l_custkey"), "left")
            columns["returns_made"] = F.coalesce(F.col("returns"), F.lit(0)).cast("int")
            columns["preferred_category"] = F.col("usual_category")
        picked = wanted or tuple(columns)
        return base.select(*[columns[name].alias(name) for name in picked])

    def monthly_revenue(self, with_returned: bool = False) -> DataFrame:
        """Calendar months of the order history; ``with_returned`` adds the number of returned orders."""
        period = [F.year("order_date").alias("year"), F.month("order_date").alias("month")]
        measures = [
            rows().alias("orders"),
            total(F.col("total_amount_usd")).alias("revenue_usd"),
            mean(F.col("total_amount_usd")).alias("avg_order_value"),
            mean(F.col("discount_pct")).alias("avg_discount_pct"),
            mean(F.col("returned")).alias("return_rate"),
            F.sum("returned").alias("returned"),
        ]
        lines = self.orders("customer_id", "order_date", "total_amount_usd", "discount_pct", "returned")
        if self._lines is None:
            by_month = lines.groupBy(*period).agg(*measures, F.countDistinct("customer_id").alias("unique_customers"))
        else:
            # from the stored lines: a second narrow scan costs less than dealing out all sums by month and customer
            buyers = self.orders("customer_id", "order_date").where("customer_id is not null").select(*period, "customer_id")
            unique = buyers.distinct().groupBy("year", "month").agg(rows().alias("unique_customers"))
            by_month = lines.groupBy(*period).agg(*measures).join(unique, ["year", "month"], "left")
            by_month = by_month.withColumn("unique_customers", F.coalesce("unique_customers", F.lit(0).cast("bigint")))
        first = self.customers("registration_date").where("registration_date is not null")
        joined = first.groupBy(
            F.year("registration_date").alias("year"), F.month("registration_date").alias("month")
        ).agg(rows().alias("new_customers"))
        return by_month.join(joined, ["year", "month"], "left").select(
            "year",
            "month",
            F.concat(F.lit("Q"), F.ceil(F.col("month") / 3).cast("int")).alias("quarter"),
            "orders",
            "revenue_usd",
            "avg_order_value",
            "avg_discount_pct",
            "return_rate",
            "unique_customers",
            F.coalesce("new_customers", F.lit(0)).cast("bigint").alias("new_customers"),
            *(["returned"] if with_returned else []),
        )

    def product_summary(self) -> DataFrame:
        """One row per product sold before the snapshot."""
        measures = self.orders().groupBy("product_id").agg(
            F.min("category").alias("category"),
            F.min("product_name").alias("product_name"),
            rows().alias("total_orders"),
            total(F.col("total_amount_usd")).alias("total_revenue_usd"),
            mean(F.col("total_amount_usd")).alias("avg_price"),
            mean(F.col("customer_rating")).alias("avg_rating"),
            (mean(F.col("returned")) * 100).alias("return_rate"),
            mean(F.col("discount_pct")).alias("avg_discount_pct"),
            mean(F.col("delivery_days")).alias("avg_delivery_days"),
        )
        return measures


def _most_frequent(value: str, count: str) -> Column:
    """Value with the largest count, the smallest value on ties; values with count 0 don't win."""
    entry = F.struct((-F.col(count)).alias("n"), F.col(value).alias("v"))
    seen = F.when((F.col(count) > 0) & F.col(value).isNotNull(), entry)
    return F.min(seen)["v"]
