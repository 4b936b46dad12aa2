"""Declared schemas of the logical tables; nothing is inferred from files."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


S, I, L, D, TS = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampType()

# Dates arrive as text; cleaning parses them so that a bad one becomes null, not an error.
RAW_CUSTOMERS = _schema(
    customer_id=S, registration_date=S, age=I, gender=S, country=S, membership_tier=S,
    preferred_category=S, preferred_device=S, preferred_payment_method=S,
    acquisition_channel=S, total_orders=I, total_spend_usd=D, avg_order_value_usd=D,
    days_since_last_purchase=I, reviews_given=I, avg_review_score=D, returns_made=I,
    wishlist_items=I, newsletter_subscribed=I, churned=I,
)

RAW_ORDERS = _schema(
    order_id=S, customer_id=S, category=S, order_date=S, delivery_date=S, delivery_days=D,
    customer_rating=D, discount_pct=D, returned=I, total_amount_usd=D,
    session_duration_minutes=D, pages_viewed_before_purchase=I, order_status=S,
)

RAW_MONTHLY_REVENUE = _schema(
    year=I, month=I, quarter=S, orders=I, revenue_usd=D, avg_order_value=D,
    avg_discount_pct=D, return_rate=D, unique_customers=I, new_customers=I,
)

PRODUCT_SUMMARY = _schema(
    category=S, product_name=S, total_orders=I, total_revenue_usd=D, avg_price=D,
    avg_rating=D, return_rate=D, avg_discount_pct=D, avg_delivery_days=D,
)

CHURN_PREDICTIONS = _schema(
    customer_id=S, churn_probability=D, predicted_churn=I, risk_tier=S, model_version=S,
)

DRIVER_IMPORTANCE = _schema(feature=S, mean_abs_shap=D)

RAW_TABLES = {
    "customers": RAW_CUSTOMERS,
    "orders": RAW_ORDERS,
    "monthly_revenue": RAW_MONTHLY_REVENUE,
    "product_summary": PRODUCT_SUMMARY,
}

# Columns every published table or view must offer (types are free: keys may be long or text).
EXPECTED_COLUMNS = {
    "customers": RAW_CUSTOMERS.names + ["customer_tenure_days"],
    "orders": RAW_ORDERS.names
    + ["rating_imputed", "order_month_label", "is_discounted", "is_returned"],
    "monthly_revenue": RAW_MONTHLY_REVENUE.names + ["period_label", "revenue_mom_pct"],
    "product_summary": PRODUCT_SUMMARY.names,
    "churn_predictions": CHURN_PREDICTIONS.names,
    "shap_importance": DRIVER_IMPORTANCE.names,
}
