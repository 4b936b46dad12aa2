"""Churn by segment: every report that groups customers and compares their churn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.binning import (
    AGE,
    AGE_QUARTILES,
    ENGAGEMENT_LABELS,
    RETURNS,
    REVIEW,
    SPEND_QUARTILES,
    WISHLIST,
    Bins,
    cut_at,
    tenure_cohort,
)
from tidemark.functions.lookup import attach
from tidemark.functions.numeric import flag, mean, percent, round_half_away, round_half_even, rows, total
from tidemark.functions.quantiles import exact_quantiles, quantile_edges
from tidemark.operators.features import DORMANT_DAYS, engagement_score

# Display order of the membership tiers.
TIER_ORDER = ("Free", "Silver", "Gold", "Platinum")


def _churned() -> Column:
    return F.col("churned") == 1


def _retained() -> Column:
    return F.col("churned") == 0


def _spend() -> Column:
    return F.col("total_spend_usd")


def mark_above_mean(grouped: DataFrame, rate: str) -> DataFrame:
    """Adds the unweighted mean of the group rates and whether a group lies above it.

    ``rate`` is not rounded. Rates are added as decimals, so the mean does not depend on the order of
    the groups; the window holds one row a group.
    """
    exact = F.col(rate).cast("decimal(24,14)")
    every = W.partitionBy()
    overall = F.try_divide(F.sum(exact).over(every).cast("double"), F.count(exact).over(every).cast("double"))
    return (
        grouped.withColumn("_overall", overall)
        .withColumn("mean_rate", round_half_away(F.col("_overall"), 4))
        .withColumn("above_mean", flag(exact.cast("double") > F.col("_overall")))
        .drop("_overall")
    )


def _marked_churn(grouped: DataFrame) -> DataFrame:
    return mark_above_mean(grouped, "_churn_rate").drop("_churn_rate")


def churn_rate_by(customers: DataFrame, *keys: str, unrounded: bool = False) -> DataFrame:
    """Customers and churn rate (4 decimals, in percent) per group; missing keys are dropped.

    ``unrounded`` adds ``_churn_rate`` for a later comparison with the mean of the groups.
    """
    known = customers
    for k in keys:
        known = known.where(F.col(k).isNotNull())
    return known.groupBy(*keys).agg(
        rows().alias("customers"),
        percent(F.col("churned"), 4).alias("churn_rate_pct"),
        *([percent(F.col("churned")).alias("_churn_rate")] if unrounded else []),
    )


def churn_by_bins(
    customers: DataFrame, source: str, bins: Bins, name: str, unrounded: bool = False
) -> DataFrame:
    """Churn rate per bin in bin order; a bin without customers keeps its row, rate missing."""
    return _by_label(customers.withColumn(name, bins.of(F.col(source))), bins, name, unrounded)


def _by_label(labelled: DataFrame, bins: Bins, name: str, unrounded: bool = False) -> DataFrame:
    found = churn_rate_by(labelled, name, unrounded=unrounded)
    dimension = bins.dimension(labelled.sparkSession, name)
    return (
        dimension.join(found, name, "left")
        .withColumn("customers", F.coalesce("customers", F.lit(0)).cast("bigint"))
        .orderBy("bucket_order")
    )


def _label_bins(labels: tuple[str, ...]) -> Bins:
    return Bins(tuple(range(len(labels) + 1)), labels)


# -- overview ----------------------------------------------------------------------------------


def churn_split(customers: DataFrame) -> DataFrame:
    """Customers, share, total and mean spend per class."""
    grouped = (
        customers.where(F.col("churned").isNotNull())
        .groupBy("churned")
        .agg(
            rows().alias("customers"),
            F.coalesce(total(_spend()), F.lit(0.0)).alias("total_spend_usd"),
            round_half_away(mean(_spend()), 2).alias("avg_ltv_usd"),
        )
    )
    everyone = F.sum("customers").over(W.partitionBy())
    return grouped.withColumn(
        "share_pct", round_half_away(F.col("customers") * 100.0 / everyone, 1)
    ).orderBy("churned")


def ltv_gap(customers: DataFrame) -> DataFrame:
    """Mean spend of both classes and how far churned customers fall below retained ones."""
    kept, lost = mean(_spend(), _retained()), mean(_spend(), _churned())
    return customers.agg(
        round_half_away(kept, 2).alias("avg_ltv_retained"),
        round_half_away(lost, 2).alias("avg_ltv_churned"),
        round_half_away(F.try_divide(kept - lost, kept) * 100, 1).alias("ltv_gap_pct"),
    )


def tier_breakdown(customers: DataFrame) -> DataFrame:
    """Tier statistics with revenue at risk, in the fixed tier order, missing tiers kept."""
    stats = customers.groupBy("membership_tier").agg(
        F.count("customer_id").alias("customers"),
        F.sum("churned").alias("churned"),
        percent(F.col("churned"), 4).alias("churn_rate_pct"),
        percent(F.col("churned")).alias("_churn_rate"),
        round_half_away(mean(_spend()), 2).alias("avg_ltv_usd"),
        F.coalesce(total(_spend(), _churned()), F.lit(0.0)).alias("revenue_at_risk_usd"),
    )
    order = _label_bins(TIER_ORDER).dimension(customers.sparkSession, "membership_tier")
    tiers = order.join(stats, "membership_tier", "left")
    return _marked_churn(tiers).orderBy("bucket_order")


def channel_stats(customers: DataFrame) -> DataFrame:
    """Churn rate and mean spend per channel, lowest churn first."""
    grouped = (
        customers.where(F.col("acquisition_channel").isNotNull())
        .groupBy("acquisition_channel")
        .agg(
            percent(F.col("churned"), 4).alias("churn_rate_pct"),
            percent(F.col("churned")).alias("_churn_rate"),
            round_half_even(mean(_spend()), 2).alias("avg_ltv_usd"),
            F.count("customer_id").alias("customers"),
        )
    )
    return _marked_churn(grouped).orderBy("churn_rate_pct", "acquisition_channel")


# -- recency and engagement ---------------------------------------------------------------------


def recency_by_class(customers: DataFrame) -> DataFrame:
    """Mean recency and share of dormant customers per class."""
    days = F.col("days_since_last_purchase")
    return (
        customers.where(F.col("churned").isNotNull())
        .groupBy("churned")
        .agg(
            round_half_away(mean(days), 4).alias("avg_recency_days"),
            percent(flag(days >= DORMANT_DAYS), 4).alias("dormant_pct"),
        )
        .orderBy("churned")
    )


def churn_by_engagement(customers: DataFrame) -> DataFrame:
    """Churn rate per engagement score, with its display label."""
    scored = customers.withColumn("engagement_score", engagement_score())
    labels = F.array(*[F.lit(x) for x in ENGAGEMENT_LABELS])
    return (
        churn_rate_by(scored, "engagement_score")
        .withColumn("engagement_level", F.get(labels, F.col("engagement_score")))
        .orderBy("engagement_score")
    )


def churn_by_wishlist(customers: DataFrame) -> DataFrame:
    return churn_by_bins(customers, "wishlist_items", WISHLIST, "wishlist_bucket")


# -- value ---------------------------------------------------------------------------------------


def quantile_label(customers: DataFrame, source: str, labels: tuple[str, ...]) -> Column:
    """Equal-count bin label of a column, lowest value included."""
    n = len(labels)
    edges = quantile_edges(customers, source, [i / n for i in range(1, n)])
    return cut_at(F.col(source).cast("double"), [edges[i] for i in range(n - 1)], labels)


def churn_by_spend_quartile(customers: DataFrame) -> DataFrame:
    """Churn rate per spend quartile and the mean of the four rates."""
    label = quantile_label(customers, "total_spend_usd", SPEND_QUARTILES)
    quartiles = _by_label(
        customers.withColumn("spend_quartile", label), _label_bins(SPEND_QUARTILES), "spend_quartile", True
    )
    return _marked_churn(quartiles).orderBy("bucket_order")


def top_spender_churn(customers: DataFrame) -> DataFrame:
    """Churn of customers at or above the third quartile of spend, next to everyone's."""
    p75 = quantile_edges(customers, "total_spend_usd", [0.75])[0]
    marked = customers.withColumn("_p75", p75)
    top = _spend().cast("double") >= F.col("_p75")
    return marked.agg(
        round_half_away(F.max("_p75"), 4).alias("p75_spend_usd"),
        F.count_if(top).alias("top_customers"),
        percent(F.col("churned"), 4, top).alias("top_churn_rate_pct"),
        percent(F.col("churned"), 4).alias("churn_rate_pct"),
    )


def churn_by_review(customers: DataFrame) -> DataFrame:
    """Churn rate per review band, among customers who reviewed."""
    reviewers = customers.where(F.col("reviews_given") > 0)
    return churn_by_bins(reviewers, "avg_review_score", REVIEW, "rating_bucket")


def churn_by_returns(customers: DataFrame) -> DataFrame:
    return churn_by_bins(customers, "returns_made", RETURNS, "return_bucket")


def churn_by_primary_category(customers: DataFrame, primary: DataFrame) -> DataFrame:
    """Churn rate per most bought category; both sides are one row per customer."""
    labelled = primary.join(customers.select("customer_id", "churned"), "customer_id")
    grouped = churn_rate_by(labelled, "primary_category", unrounded=True)
    return _marked_churn(grouped).orderBy("churn_rate_pct", "primary_category")


# -- demographics --------------------------------------------------------------------------------


def churn_by_age(customers: DataFrame) -> DataFrame:
    grouped = churn_by_bins(customers, "age", AGE, "age_group", unrounded=True)
    return _marked_churn(grouped).orderBy("bucket_order")


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values, by name on equal counts."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(rows().alias("n"))
    return counted.orderBy(F.desc("n"), column).limit(k)


def churn_by_top_countries(customers: DataFrame, k: int = 8) -> DataFrame:
    """Churn rate in the k largest countries (semi join on a list of k names)."""
    largest = top_values(customers, "country", k).select("country")
    # k rows at most: safe to broadcast.
    members = customers.join(F.broadcast(largest), "country", "left_semi")
    return _marked_churn(churn_rate_by(members, "country", unrounded=True)).orderBy(
        "churn_rate_pct", "country"
    )


def churn_by_gender(customers: DataFrame) -> DataFrame:
    return churn_rate_by(customers, "gender").orderBy("gender")


def age_quartiles(customers: DataFrame, keep: list[str]) -> DataFrame:
    """Customers with their age quartile name."""
    return customers.select(*keep, "age").withColumn(
        "age_group", quantile_label(customers, "age", AGE_QUARTILES)
    )


# -- business library ---------------------------------------------------------------------------


def executive_kpis(customers: DataFrame) -> DataFrame:
    """One row of headline figures."""
    return customers.agg(
        rows().alias("total_customers"),
        F.sum("churned").alias("total_churned"),
        percent(F.col("churned"), 2).alias("churn_rate_pct"),
        round_half_away(mean(_spend()), 2).alias("avg_ltv_usd"),
        round_half_away(total(_spend(), _churned()), 2).alias("lost_revenue_usd"),
        round_half_away(total(_spend(), _retained()), 2).alias("retained_revenue_usd"),
    )


def _segment_view(customers: DataFrame, key: str, with_churned: bool) -> DataFrame:
    measures = {
        "customers": rows(),
        "churned": F.sum("churned"),
        "churn_rate_pct": percent(F.col("churned"), 2),
        "avg_ltv_usd": round_half_away(mean(_spend()), 2),
    }
    if not with_churned:
        measures.pop("churned")
    grouped = customers.groupBy(key).agg(*[c.alias(n) for n, c in measures.items()])
    return grouped.orderBy(F.desc("churn_rate_pct"), key)


def churn_by_tier(customers: DataFrame) -> DataFrame:
    return _segment_view(customers, "membership_tier", with_churned=True)


def churn_by_channel(customers: DataFrame) -> DataFrame:
    return _segment_view(customers, "acquisition_channel", with_churned=False)


def device_payment_matrix(customers: DataFrame) -> DataFrame:
    """Churn rate and mean spend per device and payment method, worst first."""
    return (
        customers.groupBy("preferred_device", "preferred_payment_method")
        .agg(
            rows().alias("customers"),
            percent(F.col("churned"), 1).alias("churn_rate_pct"),
            round_half_away(mean(_spend()), 0).alias("avg_spend"),
        )
        .orderBy(F.desc("churn_rate_pct"), "preferred_device", "preferred_payment_method")
    )


def tenure_cohorts(customers: DataFrame) -> DataFrame:
    """Churn rate and mean spend per tenure cohort, youngest first."""
    days = F.col("customer_tenure_days")
    return (
        customers.groupBy(tenure_cohort(days).alias("tenure_cohort"))
        .agg(
            rows().alias("customers"),
            percent(F.col("churned"), 1).alias("churn_rate_pct"),
            round_half_away(mean(_spend()), 0).alias("avg_ltv"),
            F.min(days).alias("min_tenure_days"),
        )
        .orderBy("min_tenure_days")
    )


# -- distributions -------------------------------------------------------------------------------


def histogram(
    customers: DataFrame, column: str, bins: int, upper: float | None = None, by_class: bool = True
) -> DataFrame:
    """Equal-width counts between the smallest and largest value, per churn class or overall.

    Values above ``upper`` count as ``upper``. Every bin has a row; the last one is closed.
    """
    value = F.col(column).cast("double")
    if upper is not None:
        value = F.least(value, F.lit(float(upper)))
    value = F.when(F.col(column).isNotNull(), value)
    classes = (0, 1) if by_class else (None,)
    keys = [F.col("churned").cast("int").alias("churned")] if by_class else []
    data = customers.select(value.alias("v"), *keys).where("v is not null")
    wanted = {c: F.lit(True) if c is None else F.col("churned") == c for c in classes}
    bounds = data.agg(
        F.array(*[F.min(F.when(ok, F.col("v"))) for ok in wanted.values()]).alias("lo"),
        F.array(*[F.max(F.when(ok, F.col("v"))) for ok in wanted.values()]).alias("hi"),
    )
    edges = bounds.select(F.struct("lo", "hi")).scalar()
    index = F.col("churned") if by_class else F.lit(0)
    placed = data.where(F.col("churned").isin(0, 1)) if by_class else data
    lo, hi = F.get(F.col("_edges")["lo"], index), F.get(F.col("_edges")["hi"], index)
    width_one = F.when(lo == hi, lo + 0.5).otherwise(hi)
    low_one = F.when(lo == hi, lo - 0.5).otherwise(lo)
    slot = F.least(F.width_bucket("v", low_one, width_one, F.lit(bins)), F.lit(bins))
    keys = ["churned"] if by_class else []
    counted = (
        placed.withColumn("_edges", edges)
        .select(*keys, slot.cast("int").alias("bin"))
        .groupBy(*keys, "bin")
        .agg(rows().alias("n"))
    )
    spark = customers.sparkSession
    frame = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    if by_class:
        frame = frame.select(F.explode(F.array(F.lit(0), F.lit(1))).alias("churned"), "bin")
    step = (width_one - low_one) / bins
    return (
        frame.join(counted, [*keys, "bin"], "left")
        .withColumn("_edges", edges)
        .select(
            *keys,
            "bin",
            round_half_away(low_one + (F.col("bin") - 1) * step, 6).alias("bin_start"),
            round_half_away(low_one + F.col("bin") * step, 6).alias("bin_end"),
            F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
        )
        .orderBy(*keys, "bin")
    )


def class_centres(customers: DataFrame, column: str) -> DataFrame:
    """Mean and exact median of a column per churn class."""
    means = (
        customers.where(F.col("churned").isNotNull())
        .groupBy("churned")
        .agg(round_half_away(mean(F.col(column)), 4).alias("mean_value"))
    )
    medians = exact_quantiles(customers, column, [0.5], by=["churned"])
    return means.join(medians, "churned", "left").select(
        "churned", "mean_value", F.col("quantiles")[0].alias("median_value")
    )


def box_stats(customers: DataFrame, column: str) -> DataFrame:
    """Box-plot figures per churn class: quartiles, 1.5 IQR whiskers, outlier count."""
    value = F.col(column).cast("double")
    quartiles = exact_quantiles(customers, column, [0.25, 0.5, 0.75], by=["churned"]).select(
        "churned", *[F.col("quantiles")[i].alias(q) for i, q in enumerate(("q1", "median", "q3"))]
    )
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = value.between(F.col("q1") - reach, F.col("q3") + reach)
    data = customers.select("churned", column).where(F.col(column).isNotNull())
    joined = attach(data, quartiles, ["churned"], "inner")
    return (
        joined.groupBy("churned")
        .agg(
            *[F.max(q).alias(q) for q in ("q1", "median", "q3")],
            F.min(F.when(inside, value)).alias("whisker_low"),
            F.max(F.when(inside, value)).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
        .orderBy("churned")
    )
