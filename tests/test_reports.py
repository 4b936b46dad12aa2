import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import commerce, correlation, profiling, risk, segments


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_empty_bins_keep_their_row(spark):
    df = frame(spark, [(0, 1), (0, 0), (200, 1)], "wishlist_items int, churned int")
    got = [(r["wishlist_bucket"], r["customers"], r["churn_rate_pct"]) for r in segments.churn_by_wishlist(df).collect()]
    assert got == [("0 items", 2, 50.0), ("1–5", 0, None), ("6–15", 0, None), ("16+", 0, None)]


def test_missing_tier_keeps_its_row_and_mean_is_unweighted(spark):
    df = frame(
        spark,
        [("1", "Free", 1, 10.0), ("2", "Free", 1, 20.0), ("3", "Gold", 0, 5.0), ("4", "Odd", 1, 5.0)],
        "customer_id string, membership_tier string, churned int, total_spend_usd double",
    )
    got = segments.tier_breakdown(df).collect()
    assert [r["membership_tier"] for r in got] == list(segments.TIER_ORDER)
    assert [r["churn_rate_pct"] for r in got] == [100.0, None, 0.0, None]
    assert [r["above_mean"] for r in got] == [1, 0, 0, 0] and got[0]["mean_rate"] == 50.0
    assert [r["revenue_at_risk_usd"] for r in got] == [30.0, None, 0.0, None]
    kpi = segments.executive_kpis(df.where("churned = 0")).first()
    assert kpi["lost_revenue_usd"] is None and kpi["retained_revenue_usd"] == 5.0


@pytest.mark.parametrize("upper", [None, 60.0])
def test_histogram_equals_numpy(spark, upper):
    rng = np.random.default_rng(1)
    data = pd.DataFrame({"x": rng.exponential(30, 500).round(2), "churned": rng.integers(0, 2, 500)})
    got = segments.histogram(spark.createDataFrame(data), "x", 12, upper).toPandas()
    for c in (0, 1):
        values = data[data.churned == c].x
        counts, edges = np.histogram(values.clip(upper=upper) if upper else values, bins=12)
        ours = got[got.churned == c]
        assert ours.n.tolist() == counts.tolist()
        np.testing.assert_allclose(ours.bin_start, edges[:-1], atol=1e-5)


def test_histogram_of_one_value(spark):
    df = frame(spark, [(5.0,), (5.0,)], "x double")
    assert [r["n"] for r in segments.histogram(df, "x", 4, by_class=False).collect()] == [0, 0, 2, 0]


def test_box_stats(spark):
    rows = [(0, float(v)) for v in (1, 2, 3, 4, 100)] + [(1, 7.0)]
    got = {r["churned"]: r for r in segments.box_stats(frame(spark, rows, "churned int, x double"), "x").collect()}
    zero = got[0]
    assert (zero["q1"], zero["median"], zero["q3"]) == (2.0, 3.0, 4.0)
    assert (zero["whisker_low"], zero["whisker_high"], zero["outliers"]) == (1.0, 4.0, 1)
    assert got[1]["outliers"] == 0


def test_correlation_equals_pandas(spark):
    rng = np.random.default_rng(2)
    data = pd.DataFrame(rng.normal(size=(200, 3)), columns=["a", "b", "churned"])
    data["b"] += data["a"]
    data.loc[::5, "b"] = None
    df = spark.createDataFrame(data.astype(object).where(data.notna(), None), "a double, b double, churned double")
    pairs = correlation.correlation_pairs(df, ("a", "b", "churned"))
    got = {(r["feature"], r["other"]): r["r"] for r in correlation.correlation_matrix(pairs, ("a", "b", "churned")).collect()}
    expected = data.corr()
    for (x, y), r in got.items():
        assert r == pytest.approx(expected.loc[x, y], abs=1e-6)
    assert len(got) == 9


def test_rolling_mean_equals_pandas(spark):
    values = [float(v * v) for v in range(10)]
    rows = [(2020, m + 1, v) for m, v in enumerate(values)]
    got = commerce.rolling_revenue(frame(spark, rows, "year int, month int, revenue_usd double")).collect()
    expected = pd.Series(values).rolling(6, center=True).mean().round(2)
    assert [r["rolling_avg_usd"] for r in got] == [None if np.isnan(v) else v for v in expected]


def test_quadrants(spark):
    rows = [("fix", 10.0, 9.0), ("star", 10.0, 1.0), ("review", 1.0, 9.0), ("grow", 1.0, 1.0)]
    df = frame(spark, rows, "product_name string, total_revenue_usd double, return_rate double").withColumns(
        {"category": F.lit("c"), "total_orders": F.lit(1), "avg_rating": F.lit(1.0)}
    )
    got = {r["product_name"]: r["product_quadrant"] for r in commerce.product_quadrants(df).collect()}
    assert got == {"fix": commerce.FIX, "star": commerce.STAR, "review": commerce.REVIEW, "grow": commerce.GROW}


def test_duplicates_values_and_describe(spark):
    df = frame(spark, [("a", 1), ("a", 1), ("a", 2), (None, 4)], "k string, v int")
    assert profiling.duplicate_count(df).first()[0] == 1
    assert profiling.duplicate_count(df, ["k"]).first()[0] == 2
    assert {tuple(r) for r in profiling.value_counts(df, "k").collect()} == {("a", 3, 100.0)}
    assert {r[0] for r in profiling.distinct_values(df, "k").collect()} == {"a", None}
    row = profiling.describe(df).first()
    assert (row["count"], row["mean"], row["q50"], row["max"]) == (4, 2.0, 1.5, 4.0)
    assert row["std"] == pytest.approx(pd.Series([1, 1, 2, 4]).std(), abs=1e-4)
    nulls = {r["column_name"]: r["null_count"] for r in profiling.null_counts(df).collect()}
    assert nulls == {"k": 1, "v": 0, "(all columns)": 1}
    assert profiling.distinct_counts(df, ["k", "v"], exact=False).count() == 2


def test_relationships(spark):
    customers = frame(spark, [("a",), ("b",), ("b",)], "customer_id string")
    orders = frame(spark, [("a",), ("x",), ("x",), (None,)], "customer_id string")
    predictions = frame(spark, [("a",), ("a",), ("y",)], "customer_id string")
    got = {r["check_name"]: r["violations"] for r in profiling.relationship_check(customers, orders, predictions).collect()}
    assert list(got.values()) == [1, 2, 1, 1, 2]


@pytest.fixture(scope="module")
def scored(spark):
    customers = spark.range(10).select(
        F.col("id").alias("customer_id"), F.lit("X").alias("country"), F.lit(30).alias("age"),
        F.lit("Gold").alias("membership_tier"), (F.col("id") * 10.0).alias("total_spend_usd"),
        F.lit(5).alias("days_since_last_purchase"), F.lit(4.0).alias("avg_review_score"),
        F.lit(1).alias("returns_made"), F.lit("Ad").alias("acquisition_channel"),
        F.lit("Mobile").alias("preferred_device"), F.lit(4).alias("total_orders"),
    )
    scores = spark.range(10).select(F.col("id").alias("customer_id"), (F.col("id") / 10.0).alias("p"))
    return customers, risk.predictions_from(scores, "p", 0.5, "test_v1")


def test_predictions(scored):
    got = {r["customer_id"]: r for r in scored[1].collect()}
    assert got[0]["risk_tier"] == "LOW" and got[9]["risk_tier"] == "HIGH"
    assert [got[i]["predicted_churn"] for i in (4, 5)] == [0, 1]
    assert {r["model_version"] for r in got.values()} == {"test_v1"}


def test_risk_reports(scored):
    customers, predictions = scored
    assert [r["customer_id"] for r in risk.at_risk_list(customers, predictions, 3).collect()] == [9, 8, 7]
    tiers = risk.risk_tier_revenue(customers, predictions).collect()
    assert sum(r["total_at_risk_usd"] for r in tiers) == 450.0
    assert sum(r["customers"] for r in risk.tier_counts(predictions).collect()) == 10
    loss = risk.revenue_at_risk(customers, predictions).first()["expected_loss_usd"]
    assert loss == pytest.approx(sum(i * i for i in range(10)))
    assert risk.revenue_at_risk(customers, predictions, "country", total_row=True).count() == 2
    profile = risk.cohort_profile(customers, predictions, 0.65).collect()
    assert {(r["dimension"], r["segment"], r["customers"], r["returns_per_order"]) for r in profile} == {
        ("membership_tier", "Gold", 3, 0.25), ("preferred_device", "Mobile", 3, 0.25),
        ("acquisition_channel", "Ad", 3, 0.25),
    }
    assert [r["customer_id"] for r in risk.high_risk_sample(predictions, 0.75).collect()] == [9, 8]
    with pytest.raises(ValueError):
        risk.retention_list(customers, predictions, "age")


def test_annual_unique_counts_each_customer_once(spark):
    rows = [("a", dt.date(2020, 1, 1)), ("a", dt.date(2020, 5, 1)), ("b", dt.date(2021, 5, 1))]
    got = commerce.annual_unique_customers(frame(spark, rows, "customer_id string, order_date date")).collect()
    assert [tuple(r) for r in got] == [(2020, 1), (2021, 1)]
