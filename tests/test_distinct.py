import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import distinct


@pytest.fixture(scope="module")
def orders(spark):
    rng = np.random.default_rng(8)
    rows = [(f"c{rng.integers(0, 300) ** 2}", dt.date(2020 + int(rng.integers(0, 2)), int(rng.integers(1, 13)), 5)) for _ in range(4000)]
    rows += [(None, dt.date(2020, 1, 1)), ("c1", None)]
    return spark.createDataFrame(rows, "customer_id string, order_date date").repartition(5)


def test_numbering_is_dense(spark, orders):
    got = distinct.numbered(orders, "customer_id").toPandas()
    keys = {r[0] for r in orders.select("customer_id").collect()} - {None}
    assert set(got.customer_id) == keys and sorted(got.number) == list(range(len(keys)))
    assert distinct.numbered(orders.limit(0), "customer_id").count() == 0


def test_merged_months_equal_counting_the_orders(spark, orders):
    numbers = distinct.numbered(orders, "customer_id")
    bitmaps = distinct.monthly_bitmaps(orders.join(numbers, "customer_id"), "number")
    sketches = distinct.monthly_sketches(orders, "customer_id")
    got = {(r["period"], r["label"]): r for r in distinct.active_periods(bitmaps, sketches).collect()}
    frame = orders.toPandas().dropna()
    date = pd.to_datetime(frame.order_date)
    labels = {
        "month": date.dt.strftime("%Y-%m"), "quarter": date.dt.year.astype(str) + "-Q" + date.dt.quarter.astype(str),
        "year": date.dt.year.astype(str), "all": pd.Series("all", index=frame.index),
    }
    expected = {(p, k): n for p, label in labels.items() for k, n in frame.groupby(label).customer_id.nunique().items()}
    assert {k: r["unique_customers"] for k, r in got.items()} == expected
    assert all(r["estimate_agrees"] for r in got.values())


def test_a_late_month_is_merged_without_the_others(spark, orders):
    """Months written at different times and blocks far apart merge like one pass."""
    numbers = distinct.numbered(orders, "customer_id").withColumn("number", F.col("number") * 40_000)
    joined = orders.join(numbers, "customer_id")
    parts = [distinct.monthly_bitmaps(joined.where(c), "number") for c in ("month(order_date) <= 6", "month(order_date) > 6")]
    whole = distinct.members(distinct.monthly_bitmaps(joined, "number"), "year").collect()
    assert sorted(map(tuple, distinct.members(parts[0].unionByName(parts[1]), "year").collect())) == sorted(map(tuple, whole))
    assert joined.where("number >= 40000").count() > 0 and distinct.members(parts[0].limit(0), "year").count() == 0
