import pytest
from pyspark.sql import functions as F

from tidemark.operators import risk
from tidemark.sources.colocated import colocate


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_joins_on_the_key_shuffle_nothing(spark, no_broadcast):
    customers = spark.range(1000).select(F.when(F.col("id") % 50 != 0, F.col("id")).alias("customer_id"), (F.col("id") * 2).alias("spend"))
    rollup = spark.range(700).select(F.col("id").alias("customer_id"), F.lit(3).alias("orders"))
    scored = spark.range(900).select(F.col("id").alias("customer_id"), (F.col("id") % 10 / 10).alias("p"))
    made = {"customers": customers, "rollup": rollup, "scored": scored}
    stored = colocate(made, "customer_id", 8)
    joined = lambda t: t["customers"].join(t["rollup"], "customer_id", "left").join(t["scored"], "customer_id")
    near, far = joined(stored), joined(made)
    assert "Exchange" not in plan(near) and plan(far).count("Exchange") >= 3
    assert sorted(map(tuple, near.collect())) == sorted(map(tuple, far.collect()))
    grouped = stored["scored"].groupBy("customer_id").agg(F.sum("p"))
    assert "Exchange" not in plan(grouped) and grouped.count() == 900
    assert stored["customers"].where("customer_id IS NULL").count() == 20


def test_reports_on_stored_tables_join_without_a_shuffle(spark, no_broadcast):
    customers = spark.range(200).select(F.col("id").alias("customer_id"), F.lit(10.0).alias("total_spend_usd"))
    scored = spark.range(200).select(F.col("id").alias("customer_id"), F.lit("HIGH").alias("risk_tier"), F.lit(0.9).alias("churn_probability"))
    stored = colocate({"customers": customers, "scored": scored}, "customer_id", 4)
    report = risk.risk_tier_revenue(stored["customers"], stored["scored"])
    text = plan(report)
    below = text[text.index("SortMergeJoin") :] if "SortMergeJoin" in text else text[text.index("Join") :]
    final = below.split("== Initial Plan ==")[0]
    assert "Exchange" not in final
    assert report.first()["customers"] == 200
