import datetime as dt

import pytest

from tidemark.operators import profiling
from tidemark.plans import registry
from tidemark.plans.inputs import CUSTOMER_COLUMNS, Inputs
from tidemark.sources import star_schema
from tidemark.sources.star_schema import SOURCES, StarSchema

DAY = dt.datetime(2000, 1, 3)


@pytest.fixture
def folder(spark, tmp_path):
    """Lines whose part is missing, null or there twice, lines without an order, and orders that come twice."""
    tables = {
        "nation": [(1, "PERU", 1)],
        "customer": [(k, f"c{k}", 1, 100.0 * k, "AUTO") for k in range(1, 5)],
        "part": [(1, "one", "b", "TIN", 1, 1.0), (2, "two", "b", "TIN", 1, 1.0), (2, "two", "b", "STEEL", 1, 1.0), (None, "none", "b", "TIN", 1, 1.0)],
        "orders": [(10, 1, "F", 5.0, DAY, "1-URGENT"), (11, 2, "O", 5.0, DAY, "5-LOW"), (11, 2, "O", 5.0, DAY, "5-LOW"), (None, 3, "O", 1.0, DAY, None)],
        "lineitem": [
            (o, p, 1, n, 3.0, 10.0 * n, 0.05, 0.0, "R", "F", DAY)
            for n, (o, p) in enumerate([(10, 1), (10, 2), (10, 9), (10, None), (11, 2), (11, 1), (None, 1), (12, 1)], 1)
        ],
    }
    for name, rows in tables.items():
        spark.createDataFrame(rows, SOURCES[name]).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("wanted", [(), ("category", "customer_rating"), ("order_id", "order_date"), ("product_id", "product_name", "total_amount_usd")])
def test_stored_lines_give_the_rows_of_the_joins(spark, folder, wanted):
    star = StarSchema(spark, folder)
    joined = star.orders(*wanted)
    star.store_lines()
    stored = star.orders(*wanted)
    assert stored.dtypes == joined.dtypes
    assert sorted(map(str, stored.collect())) == sorted(map(str, joined.collect()))


@pytest.mark.parametrize(
    "plan", [lambda i: i.features(), registry._published_rows, registry._raw_csv, registry._exported_views], ids=["features", "published", "csv", "exported"]
)
def test_the_order_lines_are_joined_once(spark, folder, monkeypatch, plan):
    read = []
    source = star_schema.StarSchema.source
    monkeypatch.setattr(star_schema.StarSchema, "source", lambda self, name: (read.append(name), source(self, name))[1])
    plan(Inputs(spark, folder))
    assert read.count("lineitem") == 1


def test_rows_without_a_repeated_hash_are_read_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def passed(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(100).selectExpr("id", "id % 7 AS k").mapInArrow(passed, "id long, k long")
    assert profiling.duplicate_count(rows).first()["duplicates"] == 0
    assert seen.value == 100
    assert profiling.duplicate_count(rows.unionByName(rows.where("id < 5"))).first()["duplicates"] == 5


def test_customers_are_stored_once_for_reports_that_share_them(spark, folder, monkeypatch):
    inputs, kept = Inputs(spark, folder), []
    monkeypatch.setattr("tidemark.plans.inputs.settle", lambda df, name: (kept.append(name), df)[1])
    whole = inputs.customers()
    assert inputs.settled_customers().columns == whole.columns
    inputs.scored(*CUSTOMER_COLUMNS)
    features = inputs.features()
    assert kept.count("customers") == 1
    assert features.columns[: len(whole.columns)] == whole.columns


def test_months_of_stored_lines_deal_out_no_sums_by_customer(spark, folder):
    inputs = Inputs(spark, folder)
    joined = inputs.star.monthly_revenue(with_returned=True)
    before = [tuple(r) for r in joined.collect()]
    inputs.star.store_lines()
    stored = inputs.star.monthly_revenue(with_returned=True)
    assert [f.dataType for f in stored.schema] == [f.dataType for f in joined.schema]
    assert [tuple(r) for r in stored.collect()] == before and before[0][8] == 2
    plan = stored._jdf.queryExecution().sparkPlan().toString()
    by_customer = [line for line in plan.splitlines() if "Aggregate(keys" in line and "customer_id" in line.split("functions=")[0]]
    assert by_customer and all("sum(" not in line for line in by_customer)


def test_published_tables_are_stored_small(spark, folder):
    path, _ = registry._published(Inputs(spark, folder))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{path}/orders").select("path").collect()
    parts = [r["path"] for r in files if r["path"].endswith(".parquet")]
    assert parts and all(p.endswith(".zstd.parquet") for p in parts)
