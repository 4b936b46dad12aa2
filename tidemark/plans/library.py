"""The steps a user runs: clean and publish, train, query by name, export, audit."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.ml.candidates import Settings
from tidemark.ml.training import train_and_publish
from tidemark.operators import commerce, risk, segments
from tidemark.operators.cleaning import SNAPSHOT, clean_all
from tidemark.operators.features import build_features
from tidemark.session import settle
from tidemark.sources import publish, readers

CLEANED = ("customers", "orders", "monthly_revenue", "product_summary")
SCORED = ("churn_predictions", "shap_importance")


def business_views(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The four published views over the cleaned tables."""
    return {
        "v_executive_kpis": segments.executive_kpis(tables["customers"]),
        "v_churn_by_tier": segments.churn_by_tier(tables["customers"]),
        "v_churn_by_channel": segments.churn_by_channel(tables["customers"]),
        "v_revenue_trend": commerce.revenue_trend(tables["monthly_revenue"]),
    }


def open_tables(spark: SparkSession, folder: str, scored: bool = False) -> dict[str, DataFrame]:
    """Published tables as temporary views, with the business views on top."""
    tables = readers.load_clean(spark, folder, list(CLEANED + (SCORED if scored else ())))
    publish.register_views(tables)
    publish.register_views(business_views(tables))
    return tables


def clean_and_publish(
    spark: SparkSession, raw_folder: str, out_folder: str, snapshot: dt.date = SNAPSHOT
) -> dict[str, DataFrame]:
    """Load the four CSV tables, clean them, write tables and business views, register both.

    The views are written as tables of their own, so that they outlive the run.
    """
    cleaned = clean_all(readers.load_raw(spark, raw_folder), snapshot)
    publish.write_tables(cleaned, out_folder)
    tables = open_tables(spark, out_folder)
    publish.write_tables(business_views(tables), out_folder)
    return tables


def train(
    spark: SparkSession, folder: str, settings: Settings = Settings(), selection: str = "test"
) -> dict[str, DataFrame]:
    """Build features from the published tables, train, score and publish next to them."""
    tables = readers.load_clean(spark, folder, ["customers", "orders"])
    features = settle(build_features(tables["customers"], tables["orders"]), "features")
    return train_and_publish(features, folder, settings, selection)


def _t(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


# The business questions by name, over the registered tables and views.
LIBRARY: dict[str, Callable[[SparkSession], DataFrame]] = {
    "executive_kpis": lambda s: _t(s, "v_executive_kpis"),
    "churn_by_tier": lambda s: _t(s, "v_churn_by_tier"),
    "churn_by_channel": lambda s: _t(s, "v_churn_by_channel"),
    "at_risk_list": lambda s: risk.at_risk_list(_t(s, "customers"), _t(s, "churn_predictions")),
    "revenue_per_user": lambda s: commerce.revenue_per_user(_t(s, "v_revenue_trend")),
    "category_performance": lambda s: commerce.category_performance(_t(s, "orders")),
    "order_status_funnel": lambda s: commerce.order_status_funnel(_t(s, "orders")),
    "device_payment_matrix": lambda s: segments.device_payment_matrix(_t(s, "customers")),
    "tenure_cohorts": lambda s: segments.tenure_cohorts(_t(s, "customers")),
    "product_quadrants": lambda s: commerce.product_quadrants(_t(s, "product_summary")),
    "top_drivers": lambda s: risk.top_drivers(_t(s, "shap_importance")),
    "risk_tier_revenue": lambda s: risk.risk_tier_revenue(
        _t(s, "customers"), _t(s, "churn_predictions")
    ),
}
