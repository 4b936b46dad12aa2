"""Cleaned inputs of the registered queries, derived from a star-schema folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.cleaning import clean_customers, clean_monthly_revenue, clean_orders
from tidemark.operators.correlation import correlation_input, target_correlations
from tidemark.operators.features import build_features
from tidemark.operators.risk import predictions_from
from tidemark.session import settle
from tidemark.sources.star_schema import StarSchema

RULE_COLUMNS = ("age", "total_orders", "total_spend_usd", "avg_review_score")
CUSTOMER_COLUMNS = (
    "customer_id", "registration_date", "age", "gender", "country", "membership_tier",
    "preferred_category", "preferred_device", "preferred_payment_method",
    "acquisition_channel", "total_orders", "total_spend_usd", "avg_order_value_usd",
    "days_since_last_purchase", "reviews_given", "avg_review_score", "returns_made",
    "wishlist_items", "newsletter_subscribed", "churned",
)
# Order columns behind the risk score; the others need not be computed for it.
RISK_CUSTOMER_COLUMNS = (
    "customer_id", "membership_tier", "total_orders", "total_spend_usd",
    "days_since_last_purchase", "reviews_given", "avg_review_score", "wishlist_items",
    "newsletter_subscribed", "customer_tenure_days",
)
RISK_ORDER_COLUMNS = ("order_id", "customer_id", "category", "total_amount_usd", "discount_pct", "returned")

# Star-schema tables behind the features.
FACT_SOURCES = ("nation", "customer", "part", "orders", "lineitem")

ROLLUP_COLUMNS = (
    "order_id", "category", "total_amount_usd", "customer_rating", "returned", "customer_id",
    "discount_pct", "delivery_days", "session_duration_minutes", "pages_viewed_before_purchase",
)


class Inputs:
    """Logical tables of one star-schema folder, cleaned, lazily planned."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.star = StarSchema(spark, folder)
        self._stored: DataFrame | None = None

    def raw_customers(self, *columns: str) -> DataFrame:
        return self.star.customers(*columns)

    def customers(self, *columns: str) -> DataFrame:
        """Cleaned customers; naming columns keeps the plan as narrow as the report."""
        if not columns:
            return clean_customers(self.star.customers(*CUSTOMER_COLUMNS), self.star.snapshot)
        needed = dict.fromkeys(RULE_COLUMNS + tuple(c for c in columns if c != "customer_tenure_days"))
        if "customer_tenure_days" in columns:
            needed["registration_date"] = None
        if "avg_review_score" in columns:
            needed["reviews_given"] = None
        cleaned = clean_customers(self.star.customers(*needed), self.star.snapshot)
        return cleaned.select(*columns)

    def settled_customers(self, *columns: str) -> DataFrame:
        """The same, stored once, for reports that read the customers several times."""
        named = columns or (*CUSTOMER_COLUMNS, "customer_tenure_days")
        if self._stored is None or not set(named) <= set(self._stored.columns):
            self._stored = settle(self.customers(*columns), "customers")
        return self._stored.select(*named)

    def orders(self, *columns: str) -> DataFrame:
        """Cleaned orders; where ratings are filled, a narrow pass counts them first."""
        ratings = self.star.orders("category", "customer_rating")
        return clean_orders(self.star.orders(*columns), ratings)

    def revenue(self) -> DataFrame:
        return clean_monthly_revenue(self.star.monthly_revenue())

    def products(self) -> DataFrame:
        return self.star.product_summary()

    def fingerprint(self) -> str:
        """Changes when a file of the star schema does: a hash over places, sizes and times of change."""
        paths = [f"{self.star.folder}/{name}.parquet" for name in FACT_SOURCES]
        listed = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
        file = F.struct("path", "length", "modificationTime")
        return listed.agg(F.sha2(F.to_json(F.sort_array(F.collect_list(file))), 256)).first()[0]

    def features(self) -> DataFrame:
        """The full feature table; the order lines behind it are joined once."""
        self.star.store_lines(*ROLLUP_COLUMNS)
        return build_features(self.settled_customers(), self.orders(*ROLLUP_COLUMNS))

    def risk_scored(self, *columns: str) -> tuple[DataFrame, DataFrame]:
        """Stored customers holding ``columns``, and their features up to the risk score."""
        customers = self.settled_customers(*dict.fromkeys(RISK_CUSTOMER_COLUMNS + columns))
        return customers, build_features(customers, self.orders(*RISK_ORDER_COLUMNS))

    def risk_scores(self) -> DataFrame:
        """Label and rule-based risk score, stored: the quality reports read them repeatedly."""
        _, features = self.risk_scored("churned")
        return settle(features.select("customer_id", "churned", "churn_risk_score"), "scores")

    def scored(self, *columns: str) -> tuple[DataFrame, DataFrame]:
        """Customers with ``columns``, and predictions with the risk score as probability."""
        customers, features = self.risk_scored(*columns)
        return customers, predictions_from(features, "churn_risk_score", 0.5, "risk_score")

    def predictions(self) -> DataFrame:
        return self.scored()[1]

    def importance(self, customers: DataFrame | None = None) -> DataFrame:
        """Stand-in attribution: absolute correlation with the label."""
        correlations = target_correlations(correlation_input(customers or self.customers()))
        return correlations.select("feature", F.abs("r").alias("mean_abs_shap"))
