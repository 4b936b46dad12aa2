"""Edge values of readers, rounding and storage; number of fact scans; the model queries."""

import types

import pytest
from pyspark.sql import functions as F

from tidemark.ml import sampling
from tidemark.operators import cleaning, commerce, profiling, segments
from tidemark.plans.registry import MODEL_PLANS, all_queries
from tidemark.session import shared_dir
from tidemark.sources import readers

DATA = "/root/testdata/sf0.001"


def csv(tmp_path, text):
    path = tmp_path / "rows.csv"
    path.write_text(text)
    return str(path)


def test_nan_text_becomes_null(spark, tmp_path):
    path = csv(tmp_path, "name,value,count\na,NaN,1\nb,2.5,2\nc,,3\n")
    rows = readers.read_csv_table(spark, path, _schema("name string, value double, count int")).collect()
    assert [r["value"] for r in rows] == [None, 2.5, None]


def test_quotes_inside_a_field_are_doubled(spark, tmp_path):
    path = csv(tmp_path, 'name,value,count\n"27"" Monitor, black",1.0,1\n"x, y",2.0,2\n')
    rows = readers.read_csv_table(spark, path, _schema("name string, value double, count int")).collect()
    assert [tuple(r) for r in rows] == [('27" Monitor, black', 1.0, 1), ("x, y", 2.0, 2)]


def test_line_breaks_inside_a_field(spark, tmp_path):
    path = csv(tmp_path, 'name,value,count\n"two\nlines",1.0,1\n')
    rows = readers.read_csv_table(spark, path, _schema("name string, value double, count int"), multi_line=True).collect()
    assert [tuple(r) for r in rows] == [("two\nlines", 1.0, 1)]


def _schema(text):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(text)


def test_an_unrated_order_is_filled_though_the_text_said_nan(spark, tmp_path):
    path = csv(tmp_path, "category,customer_rating,order_id\na,NaN,1\na,3,2\na,5,3\n")
    df = readers.read_csv_table(spark, path, _schema("category string, customer_rating double, order_id int"))
    got = {r["order_id"]: (r["customer_rating"], r["rating_imputed"]) for r in cleaning.clean_orders(df).collect()}
    assert got == {1: (4.0, 1), 2: (3.0, 0), 3: (5.0, 0)}


def test_boosting_weight_rounds_half_to_even(spark):
    df = spark.createDataFrame([(0,)] * 9 + [(1,)] * 4, "churned int")
    got = {r["churned"]: r["boosting_weight"] for r in sampling.class_weights(df, "churned").collect()}
    assert got == {0: 1.0, 1: 2.2}


def test_means_round_half_to_even(spark):
    rows = [("a", 0.125, 2.5, 1.0), ("a", 0.125, 2.5, 1.0), ("b", 0.375, 2.5, 1.0)]
    df = spark.createDataFrame(rows, "category string, total_revenue_usd double, avg_rating double, return_rate double")
    got = {r["category"]: r["total_revenue_usd"] for r in profiling.product_category_means(df).collect()}
    assert got == {"a": 0.12, "b": 0.38}


def test_above_mean_compares_unrounded_rates(spark):
    df = spark.createDataFrame([("a", 50.00001), ("b", 50.00002)], "g string, rate double")
    got = {r["g"]: (r["mean_rate"], r["above_mean"]) for r in segments.mark_above_mean(df, "rate").collect()}
    assert got == {"a": (50.0, 0), "b": (50.0, 1)}


def test_no_storage_without_a_shared_folder_on_a_cluster():
    context = types.SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    session = types.SimpleNamespace(conf=types.SimpleNamespace(get=lambda *_: None), sparkContext=context)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session)


# Revenue of consecutive months and the published change on the month before.
MONTHS = [
    (2020, 1, 35415.25, None), (2020, 2, 34304.78, -3.14), (2020, 3, 32642.23, -4.85), (2020, 4, 34865.39, 6.81),
    (2020, 5, 38625.73, 10.79), (2020, 6, 31689.22, -17.96), (2020, 7, 31542.99, -0.46), (2020, 8, 35804.39, 13.51),
]


def test_month_over_month_gives_the_published_figures(spark):
    raw = spark.createDataFrame([m[:3] for m in MONTHS], "year int, month int, revenue_usd double")
    got = cleaning.clean_monthly_revenue(raw).orderBy("year", "month").collect()
    assert [None if r["revenue_mom_pct"] is None else round(r["revenue_mom_pct"], 2) for r in got][1:] == [m[3] for m in MONTHS][1:]


def relations(df, table):
    text = df._jdf.queryExecution().executedPlan().toString()
    return sum(f"{table}.parquet" in line for line in text.splitlines() if "FileScan" in line or "Scan parquet" in line)


@pytest.mark.parametrize("name", ["order_status_funnel", "table_totals", "category_performance", "category_returns", "category_revenue", "top_categories"])
def test_reports_scan_the_lines_once(spark, name):
    assert relations(all_queries()[name](spark, DATA), "lineitem") == 1


@pytest.mark.parametrize(
    "name",
    ["order_status_counts", "value_ranges", "duplicate_keys", "annual_unique_customers", "annual_summary", "rolling_revenue", "revenue_trend", "revenue_per_user", "cleaned_revenue"],
)
def test_parts_are_not_joined_for_nothing(spark, name):
    df = all_queries()[name](spark, DATA)
    assert relations(df, "lineitem") >= 1 and relations(df, "part") == 0


def test_follow_ups_from_a_folder_and_without_matches(spark, tmp_path):
    events = spark.read.parquet(f"{DATA}/events.parquet")
    wanted = events.where("event_type = 'error'").count()
    for name, rows, count in (("all", events, wanted), ("none", events.where("event_type <> 'error'"), 0)):
        rows.repartition(3).write.parquet(f"{tmp_path}/{name}/events.parquet")
        assert all_queries()["return_follow_ups"](spark, f"{tmp_path}/{name}").count() == count


def test_category_totals_without_any_rating(spark):
    df = spark.createDataFrame([("a", None, 1), (None, None, 2)], "category string, customer_rating double, order_id int")
    got = {r["category"]: (r["n"], r["rating_sum"]) for r in commerce.category_totals(df).collect()}
    assert got == {"a": (1, None), None: (1, None)}


@pytest.mark.parametrize("name", sorted(MODEL_PLANS))
def test_model_queries_run(spark, name):
    rows = all_queries()[name](spark, DATA).collect()
    assert rows
    if name == "model_comparison":
        assert len(rows) == 3 and all(0 < r["cv_auc"] < 1 for r in rows) and sum(r["champion"] for r in rows) == 1
    if name == "top_model_drivers":
        assert len(rows) == 15
