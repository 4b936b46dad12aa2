import pytest
from pyspark.sql import functions as F

from tidemark.operators import features as f

CUSTOMERS = (
    "customer_id string, membership_tier string, total_orders int, total_spend_usd double, "
    "days_since_last_purchase int, reviews_given int, avg_review_score double, wishlist_items int, "
    "newsletter_subscribed int, customer_tenure_days int, churned int"
)
ORDERS = (
    "order_id string, customer_id string, category string, total_amount_usd double, returned int, "
    "discount_pct double, is_discounted int, customer_rating double, delivery_days double, "
    "session_duration_minutes double, pages_viewed_before_purchase int"
)


@pytest.fixture(scope="module")
def table(spark):
    customers = spark.createDataFrame(
        [
            ("a", "Gold", 4, 100.0, 180, 2, 2.5, 0, 0, 304, 1),
            ("b", "Other", 0, 0.0, None, 0, None, 1, 1, None, 0),
            ("c", "Platinum", 16, 900.0, 30, 1, 3.0, 0, 1, 731, 0),
            ("d", "Free", 1, 100.0, 181, 0, None, 0, 0, 10, 1),
            ("e", None, 2, 500.0, 400, 0, None, 0, 0, 10, 1),
        ],
        CUSTOMERS,
    )
    orders = spark.createDataFrame(
        [
            ("1", "a", "x", 10.0, 1, 0.0, 0, 4.0, 2.0, 5.0, 1),
            ("2", "a", "y", 30.0, 0, 10.0, 1, 5.0, None, 15.0, 3),
            ("3", "c", "y", 5.0, 0, 0.0, 0, 1.0, 1.0, 1.0, 1),
            ("4", "c", "y", 5.0, 0, 0.0, 0, 1.0, 1.0, 1.0, 1),
            ("5", "c", "x", 5.0, 0, 0.0, 0, 1.0, 1.0, 1.0, 1),
            ("6", "c", None, 5.0, 0, 0.0, 0, 1.0, 1.0, 1.0, 1),
            ("7", None, "x", 5.0, 0, 0.0, 0, 1.0, 1.0, 1.0, 1),
            ("8", "c", "z", 5.0, 1, 0.0, 0, 1.0, 1.0, 1.0, 1),
        ],
        ORDERS,
    )
    return {r["customer_id"]: r for r in f.build_features(customers, orders).collect()}


def test_rows_are_customers(table):
    assert sorted(table) == list("abcde")


def test_rollup(table):
    a, b, c = table["a"], table["b"], table["c"]
    assert (a["order_count"], a["total_order_revenue"], a["avg_order_value"]) == (2, 40.0, 20.0)
    assert (a["return_rate"], a["avg_delivery_days"], a["pct_discounted_orders"]) == (0.5, 2.0, 0.5)
    assert (a["unique_categories"], a["primary_category"], a["max_discount_pct"]) == (2, "x", 10.0)
    assert b["order_count"] is None and b["return_rate"] is None
    assert (c["primary_category"], c["unique_categories"], c["order_count"]) == ("y", 3, 5)


def test_scores(table):
    a, b, c = table["a"], table["b"], table["c"]
    assert (a["recency_score"], a["frequency_score"]) == (3.0, 3.0)
    assert b["recency_score"] is None and b["rfm_score"] is None and b["churn_risk_score"] is None
    assert (c["recency_score"], c["frequency_score"], c["monetary_score"]) == (5.0, 5.0, 5.0)
    # spends 0, 100, 100, 500, 900: tied edges leave quintile 3 empty
    assert [table[k]["monetary_score"] for k in "badec"] == [1.0, 2.0, 2.0, 4.0, 5.0]
    assert a["dormant_flag"] == 1 and b["dormant_flag"] == 0
    assert [table[k]["high_value_at_risk"] for k in "abcde"] == [0, 0, 0, 0, 1]
    assert [table[k]["tier_rank"] for k in "abcde"] == [2, 0, 3, 0, 0]
    assert [table[k]["engagement_score"] for k in "abcde"] == [1, 2, 2, 0, 0]
    assert (a["high_return_flag"], b["high_return_flag"], c["high_return_flag"]) == (1, 0, 0)
    assert (a["low_satisfaction_flag"], b["low_satisfaction_flag"], c["low_satisfaction_flag"]) == (1, 0, 0)
    assert a["tenure_months"] == 10.0
    expected = (1 - 3 / 5) * 0.3 + (1 - 3 / 5) * 0.25 + 0.2 + 0.15 + (1 - 1 / 3) * 0.1
    assert a["churn_risk_score"] == pytest.approx(round(expected, 4))


def test_value_segment(table):
    assert [table[k]["value_segment"] for k in "ceadb"] == [
        "High Value", "High Value", "Mid Value", "Mid Value", "At Risk",
    ]


def test_primary_category_ties(spark):
    df = spark.createDataFrame([("a", "z"), ("a", "b"), ("b", None)], "customer_id string, category string")
    assert [tuple(r) for r in f.primary_category(df).collect()] == [("a", "b")]


def test_rollup_survives_a_dominant_customer(spark):
    n = 30_000
    df = spark.range(n).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("customer_id"),
        (F.col("id") % 7).cast("string").alias("category"),
        F.lit(1.0).alias("total_amount_usd"),
        F.lit(0).alias("returned"),
        F.lit(0.0).alias("discount_pct"),
    )
    rolled = f.order_rollup(df)
    assert rolled.where("customer_id = 0").first()["order_count"] == n // 3
    assert rolled.count() == n - n // 3 + 1
