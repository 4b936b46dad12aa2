"""Cleaning of the source tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.numeric import flag
from tidemark.functions.quantiles import quantiles_of_counts
from tidemark.functions.text import title_case
from tidemark.session import settle

# Fixed value: reporting date of the shipped extracts.
SNAPSHOT = dt.date(2026, 4, 1)

# Fixed value: the columns published in title case.
TITLE_CASED = (
    "membership_tier", "gender", "preferred_category", "preferred_device",
    "preferred_payment_method", "acquisition_channel", "country",
)


def parse_date(df: DataFrame, name: str) -> Column:
    """Text to timestamp, unparseable text to null; real dates and timestamps pass."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.try_to_timestamp(F.col(name))
    return F.col(name)


def whole_days(start: Column, end: dt.date) -> Column:
    """Complete days from ``start`` to midnight of ``end``: a started day does not count."""
    midnight = F.lit(dt.datetime.combine(end, dt.time())).cast("timestamp_ntz").cast("timestamp")
    micros = F.unix_micros(midnight) - F.unix_micros(start.cast("timestamp"))
    return F.floor(micros / 86_400_000_000).cast("int")


def valid_customer() -> Column:
    """Range rules; a missing operand fails its rule."""
    return (
        F.col("age").between(16, 100)
        & (F.col("total_orders") >= 0)
        & (F.col("total_spend_usd") >= 0)
        & F.col("avg_review_score").between(0, 5)
    )


def clean_customers(df: DataFrame, snapshot: dt.date = SNAPSHOT) -> DataFrame:
    """Typed, range-checked, title-cased customers with their tenure in days.

    Works on whichever of the text columns are present, so that a report reading three columns
    does not force the others to be computed.
    """
    present = set(df.columns)
    out = df.where(valid_customer())
    if "registration_date" in present:
        out = out.withColumn("registration_date", parse_date(df, "registration_date"))
        out = out.withColumn(
            "customer_tenure_days", whole_days(F.col("registration_date"), snapshot)
        )
    if {"reviews_given", "avg_review_score"} <= present:
        unreviewed = F.col("reviews_given") == 0
        out = out.withColumn(
            "avg_review_score",
            F.when(unreviewed, F.lit(None)).otherwise(F.col("avg_review_score")),
        )
    cased = {c: title_case(c) for c in TITLE_CASED if c in present}
    return out.withColumns(cased) if cased else out


def rejection_counters() -> dict[str, Column]:
    """How many rows each range rule turns away (a row may fail several), as aggregates over raw customers."""
    rules = {
        "age": F.col("age").between(16, 100),
        "total_orders": F.col("total_orders") >= 0,
        "total_spend_usd": F.col("total_spend_usd") >= 0,
        "avg_review_score": F.col("avg_review_score").between(0, 5),
        "any": valid_customer(),
    }
    return {name: F.count_if(~F.coalesce(ok, F.lit(False))) for name, ok in rules.items()}


def rejected_customers(df: DataFrame) -> DataFrame:
    """The same counters by a scan of their own: (rule, rejected)."""
    rules = rejection_counters()
    counts = df.agg(*[c.alias(name) for name, c in rules.items()])
    return counts.select(
        F.explode(
            F.array(
                *[F.struct(F.lit(n).alias("rule"), F.col(n).alias("rejected")) for n in rules]
            )
        ).alias("r")
    ).select("r.rule", "r.rejected")


def rating_medians(ratings: DataFrame) -> DataFrame:
    """Per category the median rating and, in every row, the median after that first fill.

    ``ratings`` are counted by (category, rating) first, whatever their number; all medians come
    from these counts, which are stored because two steps read them.
    """
    counted = ratings.groupBy("category", "customer_rating").agg(F.count(F.lit(1)).alias("_n"))
    counts = settle(counted, "rating-counts")
    medians = quantiles_of_counts(counts, "customer_rating", "_n", [0.5], by=["category"])
    known = medians.select("category", F.col("quantiles")[0].alias("_category_median"))
    filled = counts.join(known, "category", "left").withColumn(
        "_filled", F.coalesce(F.col("customer_rating").cast("double"), F.col("_category_median"))
    )
    overall = quantiles_of_counts(filled, "_filled", "_n", [0.5]).select("quantiles").scalar()
    every = counts.select("category").distinct().join(known, "category", "left")
    return settle(every.withColumn("_overall_median", overall[0]), "rating-medians")


def _fill_ratings(orders: DataFrame, ratings: DataFrame) -> DataFrame:
    """Adds ``_filled``: rating, else category median, else median of the filled column."""
    medians = rating_medians(ratings)
    lookup = medians.where(F.col("category").isNotNull()).select("category", "_category_median")
    overall = medians.agg(F.max("_overall_median")).scalar()
    rating = F.col("customer_rating").cast("double")
    return orders.join(lookup, "category", "left").withColumn(
        "_filled", F.coalesce(rating, "_category_median", overall)
    )


def clean_orders(df: DataFrame, ratings: DataFrame | None = None) -> DataFrame:
    """Typed orders with filled ratings and the month / discount / return columns.

    ``rating_imputed`` marks the rows whose rating was missing before filling. ``ratings`` is a
    narrower plan of the same orders (category and rating), for the pass that takes the medians.
    """
    names = list(df.columns)
    present = set(names)
    out = df
    for name in ("order_date", "delivery_date"):
        if name in present:
            out = out.withColumn(name, parse_date(df, name))
    if "customer_rating" in present:
        out = _fill_ratings(out, df if ratings is None else ratings)
        out = out.withColumn("rating_imputed", flag(F.col("customer_rating").isNull()))
        out = out.withColumn("customer_rating", F.col("_filled"))
        names.append("rating_imputed")
    derived = {
        "order_month_label": ("order_date", F.date_format("order_date", "yyyy-MM")),
        "is_discounted": ("discount_pct", flag(F.col("discount_pct") > 0)),
        "is_returned": ("returned", F.col("returned")),
    }
    for name, (source, value) in derived.items():
        if source in present:
            out = out.withColumn(name, value)
            names.append(name)
    return out.select(*names)


def clean_monthly_revenue(df: DataFrame) -> DataFrame:
    """Months with their label and the percentage change on the month before.

    A month without revenue counts as unchanged. The window is global, over calendar months.
    """
    by_period = W.orderBy("year", "month")
    upto = by_period.rowsBetween(W.unboundedPreceding, W.currentRow)
    padded = F.last("revenue_usd", ignorenulls=True).over(upto)
    return (
        df.withColumn("period_label", F.format_string("%d-%02d", F.col("year"), F.col("month")))
        .withColumn("_padded", padded)
        .withColumn(
            "revenue_mom_pct",
            (F.try_divide(F.col("_padded"), F.lag("_padded").over(by_period)) - 1) * 100,
        )
        .drop("_padded")
    )


def clean_all(raw: dict[str, DataFrame], snapshot: dt.date = SNAPSHOT) -> dict[str, DataFrame]:
    """The whole cleaning step, lazily; products pass through."""
    return {
        "customers": clean_customers(raw["customers"], snapshot),
        "orders": clean_orders(raw["orders"]),
        "monthly_revenue": clean_monthly_revenue(raw["monthly_revenue"]),
        "product_summary": raw["product_summary"],
    }
