"""Reports on scored customers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.binning import RISK_TIER
from tidemark.functions.numeric import mean, round_half_away, round_half_even, rows, total


def _p() -> Column:
    return F.col("churn_probability")


def _exact_p() -> Column:
    return _p().cast("decimal(9,6)")


def _spend() -> Column:
    return F.col("total_spend_usd")


def predictions_from(
    scores: DataFrame, score: str, threshold: float | Column, version: str
) -> DataFrame:
    """The prediction table: rounded probability, label by the unrounded score, tier, version."""
    p = F.col(score)
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return scores.select(
        "customer_id",
        round_half_even(p, 4).alias("churn_probability"),
        F.when(p.isNotNull(), (p >= limit).cast("int")).alias("predicted_churn"),
        RISK_TIER.of(p).alias("risk_tier"),
        F.lit(version).alias("model_version"),
    )


# Fixed value: columns of the at-risk list.
AT_RISK_COLUMNS = (
    "customer_id", "country", "age", "membership_tier", "total_spend_usd",
    "days_since_last_purchase", "avg_review_score", "returns_made", "acquisition_channel",
)


def at_risk_list(customers: DataFrame, predictions: DataFrame, k: int = 100) -> DataFrame:
    """The k customers to call first: HIGH tier and above-average spend."""
    average = customers.agg(mean(_spend())).scalar()
    high = predictions.where(F.col("risk_tier") == "HIGH").select(
        "customer_id", "churn_probability", "risk_tier"
    )
    return (
        customers.select(*AT_RISK_COLUMNS)
        .where(_spend().cast("double") > average)
        .join(high, "customer_id")
        .orderBy(F.desc("churn_probability"), F.desc("total_spend_usd"), "customer_id")
        .limit(k)
    )


def risk_tier_revenue(customers: DataFrame, predictions: DataFrame) -> DataFrame:
    """Customers, spend and mean probability per risk tier."""
    joined = predictions.join(customers.select("customer_id", "total_spend_usd"), "customer_id")
    return (
        joined.groupBy("risk_tier")
        .agg(
            rows().alias("customers"),
            round_half_away(mean(_spend()), 0).alias("avg_ltv"),
            round_half_away(total(_spend()), 0).alias("total_at_risk_usd"),
            round_half_away(mean(_exact_p()) * 100, 1).alias("avg_churn_prob_pct"),
        )
        .orderBy(F.desc("avg_churn_prob_pct"), "risk_tier")
    )


def tier_counts(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("risk_tier").agg(rows().alias("customers"))


def _expected_loss() -> Column:
    return F.sum(_exact_p() * _spend().cast("decimal(18,2)")).cast("double")


def revenue_at_risk(
    customers: DataFrame, predictions: DataFrame, *slices: str, total_row: bool = False
) -> DataFrame:
    """Expected loss (probability times spend), overall or per slice.

    ``total_row`` adds the overall figures as a row without slice values, from the same pass.
    """
    facts = customers.select("customer_id", "total_spend_usd", *slices)
    joined = predictions.select("customer_id", "churn_probability").join(facts, "customer_id")
    measures = [
        rows().alias("customers"),
        round_half_away(_expected_loss(), 2).alias("expected_loss_usd"),
    ]
    if not slices:
        return joined.agg(*measures)
    if total_row:
        return joined.groupingSets([[F.col(s) for s in slices], []], *slices).agg(*measures)
    return joined.groupBy(*slices).agg(*measures)


PROFILE_KEYS = ("membership_tier", "preferred_device", "acquisition_channel")


def cohort_profile(customers: DataFrame, predictions: DataFrame, above: float = 0.8) -> DataFrame:
    """High-risk customers by tier, device and channel: size, return rate, review mean.

    One pass with grouping sets over the joined cohort.
    """
    cohort = predictions.where(_p() > above).select("customer_id")
    facts = customers.select(
        "customer_id", *PROFILE_KEYS, "returns_made", "total_orders", "avg_review_score"
    )
    grouped = (
        cohort.join(facts, "customer_id")
        .groupingSets([[F.col(k)] for k in PROFILE_KEYS], *PROFILE_KEYS)
        .agg(
            F.grouping_id().alias("_set"),
            rows().alias("customers"),
            round_half_away(
                F.try_divide(
                    F.sum("returns_made").cast("double"), F.sum("total_orders").cast("double")
                ),
                4,
            ).alias("returns_per_order"),
            round_half_away(mean(F.col("avg_review_score")), 4).alias("avg_review_score"),
        )
    )
    # grouping_id has one bit per key, set where the key is aggregated away.
    n = len(PROFILE_KEYS)
    every = 2**n - 1
    dimension, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, key in enumerate(PROFILE_KEYS):
        mask = every - 2 ** (n - 1 - i)
        dimension = F.when(F.col("_set") == mask, F.lit(key)).otherwise(dimension)
        value = F.when(F.col("_set") == mask, F.col(key)).otherwise(value)
    return grouped.select(
        dimension.alias("dimension"),
        value.alias("segment"),
        "customers",
        "returns_per_order",
        "avg_review_score",
    ).orderBy("dimension", F.desc("customers"), "segment")


def top_drivers(importance: DataFrame, k: int = 15) -> DataFrame:
    """The k features with the largest attribution."""
    ordered = importance.orderBy(F.desc("mean_abs_shap"), "feature").limit(k)
    return ordered.select("feature", round_half_away(F.col("mean_abs_shap"), 4).alias("importance"))


def retention_list(
    customers: DataFrame, predictions: DataFrame, sort_by: str = "churn_probability", k: int | None = None
) -> DataFrame:
    """All HIGH customers for the campaign tool, by probability or by spend."""
    if sort_by not in ("churn_probability", "total_spend_usd"):
        raise ValueError(f"cannot sort by {sort_by}")
    high = predictions.where(F.col("risk_tier") == "HIGH").select("customer_id", "churn_probability")
    facts = customers.select(
        "customer_id", "membership_tier", "total_spend_usd", "days_since_last_purchase"
    )
    ordered = facts.join(high, "customer_id").orderBy(F.desc(sort_by), "customer_id")
    return ordered if k is None else ordered.limit(k)


def high_risk_sample(predictions: DataFrame, above: float = 0.8, k: int = 100) -> DataFrame:
    """The k most likely churners above a probability."""
    return (
        predictions.where(_p() > above)
        .select("customer_id", "churn_probability", "risk_tier")
        .orderBy(F.desc("churn_probability"), "customer_id")
        .limit(k)
    )


def insight_report(
    customers: DataFrame, predictions: DataFrame, importance: DataFrame, above: float = 0.8
) -> DataFrame:
    """Everything the executive report quotes, as (section, rank_key, item, value) rows."""

    def section(name: str, df: DataFrame, item: Column, value: Column, key: Column) -> DataFrame:
        return df.select(
            F.lit(name).alias("section"),
            key.cast("string").alias("rank_key"),
            item.cast("string").alias("item"),
            value.cast("double").alias("value"),
        )

    sample = high_risk_sample(predictions, above)
    drivers = top_drivers(importance, 5)
    tiers = tier_counts(predictions)
    profile = cohort_profile(customers, predictions, above)
    parts = [
        section("high-risk sample", sample, F.col("customer_id"), _p(), F.col("risk_tier")),
        section("top drivers", drivers, F.col("feature"), F.col("importance"), F.lit("")),
        section("customers per tier", tiers, F.col("risk_tier"), F.col("customers"), F.lit("")),
        section(
            "revenue at risk",
            revenue_at_risk(customers, predictions),
            F.lit("expected loss"),
            F.col("expected_loss_usd"),
            F.lit(""),
        ),
        section(
            "high-risk cohort", profile, F.col("segment"), F.col("customers"), F.col("dimension")
        ),
    ]
    return reduce(DataFrame.unionByName, parts)
