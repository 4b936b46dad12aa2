import glob

import pytest
from pyspark.sql import functions as F

from tidemark.ml.candidates import LOGISTIC, Settings
from tidemark.plans import library
from tidemark.plans.inputs import CUSTOMER_COLUMNS, Inputs
from tidemark.session import settle, shared_dir
from tidemark.sources import publish, readers
from tidemark.sources.schemas import RAW_ORDERS, RAW_TABLES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """The four CSV tables, written from the star schema."""
    folder = str(tmp_path_factory.mktemp("raw"))
    star = Inputs(spark, DATA).star
    frames = {
        "customers": star.customers(*CUSTOMER_COLUMNS),
        "orders": star.orders().select(*RAW_ORDERS.names, F.lit("x").alias("unused")),
        "monthly_revenue": star.monthly_revenue().select(*RAW_TABLES["monthly_revenue"].names),
        "product_summary": star.product_summary().select(*RAW_TABLES["product_summary"].names),
    }
    for name, df in frames.items():
        df.write.option("header", True).csv(f"{folder}/{name}.csv")
    return folder


@pytest.fixture(scope="module")
def published(spark, raw, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    library.clean_and_publish(spark, raw, out, Inputs(spark, DATA).star.snapshot)
    return out


def test_cleaning_from_csv_equals_cleaning_in_memory(spark, published):
    i = Inputs(spark, DATA)
    ours = spark.table("v_churn_by_tier").collect()
    assert ours == spark.read.parquet(f"{published}/v_churn_by_tier").collect()
    direct = __import__("tidemark.plans.registry", fromlist=["PLANS"]).PLANS["churn_by_tier"](i).collect()
    assert [tuple(r) for r in ours] == [tuple(r) for r in direct]
    assert dict(spark.table("customers").dtypes)["registration_date"] == "timestamp"


def test_train_query_export_audit(spark, published, tmp_path):
    out = library.train(spark, published, Settings(models=(LOGISTIC,), folds=2))
    assert out["comparison"].count() == 1 and out["report"].count() == 5
    tables = library.open_tables(spark, published, scored=True)
    n = tables["customers"].count()
    assert tables["churn_predictions"].count() == n and tables["shap_importance"].count() == 32
    for name, query in library.LIBRARY.items():
        assert query(spark).count() > 0, name
    assert library.LIBRARY["executive_kpis"](spark).first()["total_customers"] == n
    assert library.LIBRARY["risk_tier_revenue"](spark).agg(F.sum("customers")).first()[0] == n
    audit = publish.audit_columns(spark, tables)
    assert audit.where("status = 'missing'").count() == 0
    counts = {r["table_name"]: r["row_count"] for r in publish.audit_rows(tables).collect()}
    assert counts["customers"] == n
    folder = str(tmp_path / "csv")
    publish.export_csv(spark, folder)
    for name in publish.EXPORTS:
        back = spark.read.option("header", True).csv(f"{folder}/{name}")
        assert back.count() == spark.table(name).count(), name
    assert len(glob.glob(f"{folder}/v_churn_by_tier/*.csv")) == 1
    assert set(publish.catalog_tables(spark, ["customers", "nope"])) == {"customers"}


def test_audit_reports_missing_and_additional(spark):
    got = publish.audit_columns(spark, {"t": spark.range(1)}, {"t": ["x"], "u": ["y"]})
    assert {(r["column_name"], r["status"]) for r in got.collect()} == {
        ("id", "additional"), ("x", "missing"), ("y", "missing"),
    }


def test_corrupt_lines_and_missing_columns(spark, tmp_path):
    folder = tmp_path / "bad"
    folder.mkdir()
    path = str(folder / "shap.csv")
    with open(path, "w") as out:
        out.write("feature,mean_abs_shap\na,0.5\nb,much\n")
    schema = __import__("tidemark.sources.schemas", fromlist=["x"]).DRIVER_IMPORTANCE
    rows = readers.read_csv_table(spark, path, schema, keep_corrupt=True).collect()
    assert [(r["feature"], r["mean_abs_shap"], r["_corrupt_record"]) for r in rows] == [
        ("a", 0.5, None), ("b", None, "b,much"),
    ]
    with open(str(folder / "customers.csv"), "w") as out:
        out.write("customer_id\n1\n")
    with pytest.raises(ValueError, match="lacks columns"):
        readers.load_raw(spark, str(folder))


def test_catalog_tables_are_replaced_and_bucketed(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS tidemark_test")
    try:
        for n in (5, 7):
            publish.replace_catalog_tables({"t": spark.range(n)}, "tidemark_test", {"t": (4, "id")})
        table = spark.table("tidemark_test.t")
        assert table.count() == 7
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = table.join(table.select("id"), "id")._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP DATABASE tidemark_test CASCADE")


def test_settled_rows_come_from_shared_storage(spark):
    df = settle(spark.range(10), "numbers")
    assert df.count() == 10
    assert df.inputFiles()[0].split(":", 1)[-1].lstrip("/").startswith(shared_dir(spark).split(":", 1)[-1].lstrip("/"))
