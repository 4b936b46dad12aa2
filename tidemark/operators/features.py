"""Order rollup and the per-customer feature table."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.binning import FREQUENCY, RECENCY, cut_at
from tidemark.functions.numeric import flag, round_half_even
from tidemark.functions.quantiles import exact_quantiles

# Model inputs and target.
NUMERIC_FEATURES = (
    "age", "total_orders", "total_spend_usd", "avg_order_value_usd",
    "days_since_last_purchase", "reviews_given", "avg_review_score",
    "returns_made", "wishlist_items", "newsletter_subscribed",
    "customer_tenure_days", "rfm_score", "recency_score",
    "frequency_score", "monetary_score", "tier_rank",
    "engagement_score", "high_return_flag", "low_satisfaction_flag",
    "dormant_flag", "churn_risk_score", "return_rate",
    "avg_session_mins", "avg_pages_viewed", "pct_discounted_orders",
    "unique_categories",
)
CATEGORICAL_FEATURES = (
    "gender", "membership_tier", "preferred_category", "preferred_device",
    "preferred_payment_method", "acquisition_channel",
)
TARGET = "churned"

# Scoring rules.
TIER_RANK = {"Free": 0, "Silver": 1, "Gold": 2, "Platinum": 3}
DAYS_PER_MONTH = 30.44
DORMANT_DAYS = 180
HIGH_RETURN_RATE = 0.20
LOW_REVIEW_SCORE = 3
RFM_WEIGHTS = (0.35, 0.35, 0.30)  # recency, frequency, monetary
RISK_WEIGHTS = (0.30, 0.25, 0.20, 0.15, 0.10)  # recency, frequency, returns, satisfaction, engagement
VALUE_SEGMENTS = ("High Value", "Mid Value", "Low Value")
VALUE_REST = "At Risk"

_QUINTILES = (0.2, 0.4, 0.6, 0.8)
_QUARTILES = (0.25, 0.5, 0.75)


def _mean_of(total: str, count: str) -> Column:
    return F.try_divide(F.sum(total).cast("double"), F.sum(count).cast("double"))


def order_rollup(orders: DataFrame) -> DataFrame:
    """One row per customer; averages whose source column is absent are left out.

    Rows are reduced to (customer, category) first and to the customer second: the number of
    categories and the primary category then need no distinct aggregation, and a customer with
    very many orders arrives in one task as a few pre-added rows only.
    """
    averaged = {
        "session_duration_minutes": "avg_session_mins",
        "pages_viewed_before_purchase": "avg_pages_viewed",
        "customer_rating": "avg_rating_orders",
        "delivery_days": "avg_delivery_days",
        "is_discounted": "pct_discounted_orders",
    }
    averaged = {c: name for c, name in averaged.items() if c in orders.columns}
    partial = [
        F.count("order_id").alias("orders_n"),
        F.count("category").alias("category_n"),
        F.sum("total_amount_usd").alias("amount_sum"),
        F.count("total_amount_usd").alias("amount_n"),
        F.sum("returned").alias("returned_sum"),
        F.max("discount_pct").alias("max_discount"),
    ]
    for c, name in averaged.items():
        partial += [F.sum(c).alias(f"{name}_sum"), F.count(c).alias(f"{name}_n")]
    per_category = (
        orders.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id", "category")
        .agg(*partial)
    )
    preferred = F.when(
        F.col("category").isNotNull(), F.struct(-F.col("category_n"), F.col("category").alias("v"))
    )
    rolled = per_category.groupBy("customer_id").agg(
        F.sum("orders_n").alias("order_count"),
        F.coalesce(F.sum("amount_sum").cast("double"), F.lit(0.0)).alias("total_order_revenue"),
        _mean_of("amount_sum", "amount_n").alias("avg_order_value"),
        *[_mean_of(f"{name}_sum", f"{name}_n").alias(name) for name in averaged.values()],
        F.coalesce(F.sum("returned_sum"), F.lit(0)).cast("bigint").alias("total_returns"),
        F.count("category").alias("unique_categories"),
        F.max("max_discount").cast("double").alias("max_discount_pct"),
        F.min(preferred)["v"].alias("primary_category"),
    )
    placed = F.greatest(F.col("order_count"), F.lit(1)).cast("double")
    return rolled.withColumns(
        {
            "return_rate": F.col("total_returns").cast("double") / placed,
            "revenue_per_order": F.col("total_order_revenue") / placed,
        }
    )


def primary_category(orders: DataFrame) -> DataFrame:
    """The category each customer bought most, the alphabetically first on ties."""
    counted = (
        orders.where(F.col("customer_id").isNotNull() & F.col("category").isNotNull())
        .groupBy("customer_id", "category")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = F.min(F.struct(-F.col("n"), F.col("category").alias("v")))
    return counted.groupBy("customer_id").agg(best["v"].alias("primary_category"))


def engagement_score() -> Column:
    """0 to 3: newsletter, any wishlist item, any review."""
    return (
        F.col("newsletter_subscribed").cast("int")
        + flag(F.col("wishlist_items") > 0)
        + flag(F.col("reviews_given") > 0)
    )


def spend_ranks(customers: DataFrame) -> Column:
    """Neighbouring spends around all cut points, one scalar subquery for every spend-based bin."""
    probs = sorted(_QUINTILES + _QUARTILES)
    ranks = exact_quantiles(customers, "total_spend_usd", probs)
    return ranks.select(F.struct("lower", "upper", "fraction")).scalar()


def _edges(ranks: Column, probs: tuple[float, ...], shape=lambda c: c) -> list[Column]:
    order = sorted(_QUINTILES + _QUARTILES)
    out = []
    for p in probs:
        i = order.index(p)
        lo, hi = shape(ranks["lower"][i]), shape(ranks["upper"][i])
        out.append(lo + (hi - lo) * ranks["fraction"][i])
    return out


def _shifted_spend(c: Column) -> Column:
    return F.greatest(c, F.lit(0.0)) + F.lit(0.01)


def monetary_score(spend: Column, ranks: Column) -> Column:
    """Quintile of the (non-negative, shifted) spend, 1 to 5."""
    shifted = F.when(spend.isNotNull(), _shifted_spend(spend))
    return cut_at(shifted, _edges(ranks, _QUINTILES, _shifted_spend), (1, 2, 3, 4, 5))


def value_segment(spend: Column, ranks: Column) -> Column:
    """Segment by quartile thresholds that belong to the upper segment."""
    p25, p50, p75 = _edges(ranks, _QUARTILES)
    high, mid, low = VALUE_SEGMENTS
    return (
        F.when(spend >= p75, high).when(spend >= p50, mid).when(spend >= p25, low)
    ).otherwise(VALUE_REST)


def build_features(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers with rollup and engineered features; rows = customers.

    ``customers`` is read by the join and by two narrow quantile passes; pass a stored table (or
    ``settle`` it) when it is the result of an expensive plan.
    """
    spend = F.col("total_spend_usd").cast("double")
    tiers = F.create_map(*[F.lit(x) for pair in TIER_RANK.items() for x in pair])
    joined = customers.join(order_rollup(orders), "customer_id", "left")
    scored = joined.withColumn("_ranks", spend_ranks(customers)).withColumns(
        {
            "recency_score": RECENCY.of(F.col("days_since_last_purchase")).cast("double"),
            "frequency_score": FREQUENCY.of(F.col("total_orders")).cast("double"),
            "monetary_score": monetary_score(spend, F.col("_ranks")).cast("double"),
            "value_segment": value_segment(spend, F.col("_ranks")),
            "tenure_months": round_half_even(F.col("customer_tenure_days") / DAYS_PER_MONTH, 1),
            "tier_rank": F.coalesce(F.try_element_at(tiers, F.col("membership_tier")), F.lit(0)),
            "engagement_score": engagement_score(),
            "high_return_flag": flag(F.col("return_rate") > HIGH_RETURN_RATE),
            "low_satisfaction_flag": flag(F.col("avg_review_score") < LOW_REVIEW_SCORE),
            "dormant_flag": flag(F.col("days_since_last_purchase") >= DORMANT_DAYS),
        }
    )
    r, f, m = F.col("recency_score"), F.col("frequency_score"), F.col("monetary_score")
    parts = (
        1 - r / 5, 1 - f / 5, F.col("high_return_flag"), F.col("low_satisfaction_flag"),
        1 - F.col("engagement_score") / 3,
    )
    risk = reduce(add, (part * weight for part, weight in zip(parts, RISK_WEIGHTS)))
    rfm = reduce(add, (part * weight for part, weight in zip((r, f, m), RFM_WEIGHTS)))
    return scored.drop("_ranks").withColumns(
        {
            "rfm_score": rfm,
            "high_value_at_risk": flag((m >= 4) & (F.col("dormant_flag") == 1)),
            "churn_risk_score": round_half_even(risk, 4),
        }
    )
