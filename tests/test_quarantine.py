import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import cleaning, profiling
from tidemark.sources import quarantine

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()), T.StructField("x", T.DoubleType())])


def test_lines_that_do_not_fit_are_set_apart(spark, tmp_path):
    for k, lines in enumerate((['1,a,0.5', '2,"b, c",1.5', 'x,d,2.5', '3,"say ""hi""",'], ["4,e", "5,f,1.0,9", "6,g,much", ",,"])):
        (tmp_path / f"part-{k}.csv").write_text("id,name,x\n" + "\n".join(lines) + "\n")
    split = quarantine.split_lines(spark, str(tmp_path), SCHEMA)
    assert sorted(map(tuple, split.good.collect()), key=repr) == sorted(
        [(1, "a", 0.5), (2, "b, c", 1.5), (3, 'say "hi"', None), (None, None, None)], key=repr
    )
    bad = {r["line"]: (r["file"], r["reason"]) for r in split.quarantine.collect()}
    assert bad == {
        "x,d,2.5": ("part-0.csv", "id is no int"), "4,e": ("part-1.csv", "2 fields instead of 3"),
        "5,f,1.0,9": ("part-1.csv", "4 fields instead of 3"), "6,g,much": ("part-1.csv", "x is no double"),
    }
    assert split.counts == {"lines": 8, "quarantined": 4, "kept": 4}


def test_counters_come_with_the_write(spark, tmp_path):
    schema = "age int, total_orders int, total_spend_usd double, avg_review_score double"
    raw = spark.createDataFrame([(20, 1, 1.0, 2.0), (10, 1, 1.0, 2.0), (None, -1, 1.0, 9.0)], schema)
    watched, seen = quarantine.observed(raw, "raw", {"rows": F.count(F.lit(1))} | cleaning.rejection_counters())
    watched.where(cleaning.valid_customer()).write.parquet(str(tmp_path / "t"))
    got = {r["counter"]: r["value"] for r in quarantine.counters(spark, {"raw": seen}).collect()}
    plain = {r["rule"]: r["rejected"] for r in cleaning.rejected_customers(raw).collect()}
    assert got == {"rows": 3} | plain == {"rows": 3, "age": 2, "total_orders": 1, "total_spend_usd": 0, "avg_review_score": 1, "any": 2}
    empty, none = quarantine.observed(raw.limit(0), "none", {"rows": F.count(F.lit(1)), "total": F.sum("age")})
    empty.collect()
    assert {r["counter"]: r["value"] for r in quarantine.counters(spark, {"none": none}).collect()} == {"rows": 0, "total": 0}


@pytest.mark.parametrize("n", [0, 1, 300])
def test_duplicates_by_hash_first(spark, n):
    rows = [(k % 50, None if k % 3 else "a", float(k % 7)) for k in range(n)] + [(None, "a", None), ("1" and 1, None, None)] * (n > 1)
    df = spark.createDataFrame(rows, "k int, t string, x double").repartition(3)
    assert profiling.duplicate_count(df).first()[0] == len(rows) - len(set(rows))


def test_hashes_alike_are_told_apart(spark):
    """xxhash64 leaves nulls out: (1, null) and (null, 1) share a hash, and are no duplicates."""
    df = spark.createDataFrame([(1, None), (None, 1), (1, None)], "a int, b int")
    assert df.select(F.countDistinct(F.xxhash64("a", "b"))).first()[0] == 1
    assert profiling.duplicate_count(df).first()[0] == 1


def test_shapes_in_one_pass(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "k int, t string")
    got = profiling.shapes_in_one_pass(df, "lines", 2, {"keys": ([F.col("k")], 5), "pairs": ([F.col("k"), F.col("t")], 3)})
    assert {tuple(r) for r in got.collect()} == {("lines", 3, 2), ("keys", 2, 5), ("pairs", 3, 3)}
    assert got._jdf.queryExecution().executedPlan().toString().count("Scan") <= 2


def test_models_still_score_after_counting(spark):
    """Observed counters stay with the session; a fitted model must not carry it into tasks."""
    from tidemark.ml import training
    from tidemark.ml.candidates import LOGISTIC, Settings

    watched, seen = quarantine.observed(spark.range(5), "before", {"rows": F.count(F.lit(1))})
    watched.collect()
    assert seen.get == {"rows": 5}
    rows = [(k, k % 2, float(k % 7) + k % 2, "x") for k in range(80)]
    df = spark.createDataFrame(rows, "customer_id long, churned int, age double, gender string")
    result = training.compare(df, Settings(models=(LOGISTIC,)), cross_validate=False)
    assert training.predict_all(result.champion, df).count() == 80
