"""Order, revenue and product reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.numeric import mean, percent, round_half_away, round_half_even, rows, total
from tidemark.operators.segments import mark_above_mean

# Labels of the product quadrants.
FIX = "High Revenue / High Return — Fix Quality"
STAR = "Star Product — Promote"
REVIEW = "Low Revenue / High Return — Review or Discontinue"
GROW = "Low Revenue / Low Return — Grow or Phase Out"


def _amount() -> Column:
    return F.col("total_amount_usd")


def category_totals(orders: DataFrame) -> DataFrame:
    """Sums and counts per category in one pass over the orders, missing ratings filled.

    Orders are added up by (category, rating); medians and filling work on these rows, of which there
    are as many as categories times rating values. Already filled ratings stay as they are.
    """
    measures = {"amount": "total_amount_usd", "ret": "returned", "disc": "discount_pct", "deliv": "delivery_days"}
    present = {k: c for k, c in measures.items() if c in orders.columns}
    partial = [F.count(F.lit(1)).alias("n"), F.count("order_id").alias("ids")]
    for k, c in present.items():
        partial += [F.sum(c).alias(f"{k}_sum"), F.count(c).alias(f"{k}_n")]
    levels = orders.groupBy("category", F.col("customer_rating").cast("double").alias("rating")).agg(*partial)
    levels = _with_median(levels, "rating", ["category"], "median")
    own = F.when(F.col("category").isNotNull(), F.col("median"))
    levels = _with_median(levels.withColumn("first_fill", F.coalesce("rating", own)), "first_fill", [], "overall")
    filled = F.coalesce("first_fill", "overall")
    sums = [F.sum(c).alias(c) for c in ("n", "ids", *(f"{k}_{e}" for k in present for e in ("sum", "n")))]
    return levels.groupBy("category").agg(
        *sums,
        F.sum(filled * F.col("n")).alias("rating_sum"),
        F.sum(F.when(filled.isNotNull(), F.col("n"))).alias("rating_n"),
    )


def _with_median(levels: DataFrame, value: str, by: list[str], name: str) -> DataFrame:
    """Adds the median of ``value``, counted ``n`` times a row, within the groups ``by``."""
    known = F.col(value).isNotNull()
    whole = W.partitionBy(*by)
    upto = whole.orderBy(value).rangeBetween(W.unboundedPreceding, W.currentRow)
    count = F.when(known, F.col("n")).otherwise(0)
    middle = (F.col("_all") - 1) / 2
    at = lambda rank: F.min(F.when(known & (F.col("_upto") > rank), F.col(value))).over(whole)
    ranked = levels.withColumn("_upto", F.sum(count).over(upto)).withColumn("_all", F.sum(count).over(whole))
    ends = ranked.withColumn("_low", at(F.floor(middle))).withColumn("_high", at(F.ceil(middle)))
    share = middle - F.floor(middle)
    median = F.col("_low") + (F.col("_high") - F.col("_low")) * share
    return ends.withColumn(name, median).drop("_upto", "_all", "_low", "_high")


def _mean(name: str) -> Column:
    return F.try_divide(F.col(f"{name}_sum").cast("double"), F.col(f"{name}_n").cast("double"))


def category_performance(orders: DataFrame) -> DataFrame:
    """Volume, revenue, rating, returns, discount and delivery per category."""
    return (
        category_totals(orders)
        .select(
            "category",
            F.col("n").alias("total_orders"),
            round_half_away(F.col("amount_sum").cast("double"), 0).alias("total_revenue"),
            round_half_away(_mean("amount"), 2).alias("avg_order_value"),
            round_half_away(_mean("rating"), 2).alias("avg_rating"),
            round_half_away(_mean("ret") * 100, 1).alias("return_rate_pct"),
            round_half_away(_mean("disc"), 1).alias("avg_discount_pct"),
            round_half_away(_mean("deliv"), 1).alias("avg_delivery_days"),
        )
        .orderBy(F.desc("total_revenue"), "category")
    )


def order_status_funnel(orders: DataFrame) -> DataFrame:
    """Orders, share of all orders and value per status; the share is a window over the statuses."""
    grouped = orders.groupBy("order_status").agg(
        rows().alias("orders"), round_half_away(total(_amount()), 0).alias("total_value")
    )
    everything = F.sum("orders").over(W.partitionBy())
    share = round_half_away(F.col("orders") * 100.0 / everything, 1)
    return grouped.select(
        "order_status", "orders", share.alias("pct_of_total"), "total_value"
    ).orderBy(F.desc("orders"), "order_status")


def _category_stats(orders: DataFrame) -> DataFrame:
    return (
        category_totals(orders)
        .where(F.col("category").isNotNull())
        .select(
            "category",
            F.col("amount_sum").cast("double").alias("revenue"),
            (_mean("ret") * 100).alias("_return_rate"),
            _mean("rating").alias("_rating"),
            F.col("ids").alias("orders"),
        )
    )


def _rounded(stats: DataFrame, rate: Column, rating: Column) -> DataFrame:
    return stats.withColumn("return_rate_pct", rate).withColumn("avg_rating", rating).drop("_return_rate", "_rating")


def _four_digits(stats: DataFrame) -> DataFrame:
    return _rounded(
        stats, round_half_away(F.col("_return_rate"), 4), round_half_away(F.col("_rating"), 4)
    )


def category_returns(orders: DataFrame, label_length: int = 12) -> DataFrame:
    """Return rate against rating per category, with a short label."""
    return (
        _four_digits(_category_stats(orders))
        .drop("revenue")
        .withColumn("short_label", F.left(F.col("category"), F.lit(label_length)))
        .orderBy("category")
    )


def most_returned_categories(orders: DataFrame, k: int = 1) -> DataFrame:
    stats = (
        orders.where(F.col("category").isNotNull())
        .groupBy("category")
        .agg(percent(F.col("returned"), 4).alias("return_rate_pct"))
    )
    return stats.orderBy(F.desc("return_rate_pct"), "category").limit(k)


def category_revenue(orders: DataFrame) -> DataFrame:
    """Revenue per category and whether its return rate is above the mean of categories."""
    marked = _four_digits(mark_above_mean(_category_stats(orders), "_return_rate"))
    return marked.withColumn("revenue", round_half_away(F.col("revenue"), 2)).orderBy(
        "revenue", "category"
    )


def top_categories(orders: DataFrame, k: int = 5) -> DataFrame:
    """Highest revenue first; rounded to even at two digits."""
    stats = _rounded(
        _category_stats(orders).withColumn("revenue", round_half_even(F.col("revenue"), 2)),
        round_half_even(F.col("_return_rate"), 2),
        round_half_even(F.col("_rating"), 2),
    )
    return stats.orderBy(F.desc("revenue"), "category").limit(k)


# -- monthly revenue: at most twelve rows a year, so global windows are fine ---------------------


def revenue_trend(revenue: DataFrame) -> DataFrame:
    """Projection of the cleaned months published as a view."""
    return revenue.select(
        "year",
        "month",
        "quarter",
        "revenue_usd",
        "unique_customers",
        "new_customers",
        round_half_away(F.col("return_rate") * 100, 2).alias("return_rate_pct"),
        "period_label",
        round_half_away(F.col("revenue_mom_pct"), 2).alias("mom_growth_pct"),
    )


def revenue_per_user(trend: DataFrame) -> DataFrame:
    """The trend with revenue per active customer."""
    arpu = F.try_divide(F.col("revenue_usd"), F.col("unique_customers").cast("double"))
    return trend.select(
        "period_label",
        "revenue_usd",
        "unique_customers",
        "new_customers",
        "return_rate_pct",
        "mom_growth_pct",
        round_half_away(arpu, 2).alias("arpu"),
    ).orderBy("period_label")


def rolling_revenue(revenue: DataFrame, width: int = 6) -> DataFrame:
    """Centred rolling mean; missing until the window is full."""
    before = width // 2
    window = W.orderBy("year", "month").rowsBetween(-before, width - before - 1)
    full = F.count("revenue_usd").over(window) == width
    centred = F.when(full, F.avg("revenue_usd").over(window))
    return revenue.select(
        "year",
        "month",
        F.format_string("%d-%02d", F.col("year"), F.col("month")).alias("period_label"),
        "revenue_usd",
        round_half_away(centred, 2).alias("rolling_avg_usd"),
    ).orderBy("year", "month")


def annual_summary(revenue: DataFrame) -> DataFrame:
    """Yearly totals; ``unique_customers`` adds up the monthly figures."""
    return (
        revenue.groupBy("year")
        .agg(
            total(F.col("revenue_usd")).alias("_revenue"),
            F.sum("new_customers").alias("new_customers"),
            F.sum("unique_customers").alias("unique_customers"),
        )
        .select(
            "year",
            round_half_away(F.col("_revenue"), 2).alias("revenue_usd"),
            round_half_even(F.col("_revenue") / 1e6, 2).alias("revenue_m"),
            "new_customers",
            "unique_customers",
        )
        .orderBy("year")
    )


def annual_unique_customers(orders: DataFrame) -> DataFrame:
    """Customers with at least one order in the year, each counted once."""
    return (
        orders.where(F.col("order_date").isNotNull())
        .groupBy(F.year("order_date").alias("year"))
        .agg(F.countDistinct("customer_id").alias("unique_customers"))
        .orderBy("year")
    )


# -- products -------------------------------------------------------------------------------------


def product_quadrants(products: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Products placed by revenue and return rate against the two averages."""
    averages = products.agg(
        F.struct(
            mean(F.col("total_revenue_usd")).alias("revenue"), mean(F.col("return_rate")).alias("ret")
        )
    ).scalar()
    rich = F.col("total_revenue_usd") > F.col("_avg.revenue")
    returned = F.col("return_rate") > F.col("_avg.ret")
    poor = F.col("total_revenue_usd") <= F.col("_avg.revenue")
    liked = F.col("return_rate") <= F.col("_avg.ret")
    quadrant = (
        F.when(rich & returned, FIX)
        .when(rich & liked, STAR)
        .when(poor & returned, REVIEW)
        .otherwise(GROW)
    )
    return (
        products.withColumn("_avg", averages)
        .select(
            *(key or []),
            "product_name",
            "category",
            "total_orders",
            round_half_away(F.col("total_revenue_usd"), 0).alias("revenue"),
            "avg_rating",
            "return_rate",
            quadrant.alias("product_quadrant"),
        )
        .orderBy(F.desc("revenue"), "product_name")
    )


def quadrant_sizes(products: DataFrame) -> DataFrame:
    """Number of products per quadrant."""
    placed = product_quadrants(products)
    return placed.groupBy("product_quadrant").agg(rows().alias("products"))
