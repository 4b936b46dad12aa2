"""Publishing in one switch: readers see all tables before or all after, in views too."""

import threading

import pytest
from pyspark.sql import functions as F

from tidemark.plans import registry
from tidemark.plans.inputs import Inputs
from tidemark.sources import versions


def pair(spark, k, n=200):
    rows = spark.range(n * (k + 1)).withColumn("v", F.lit(k))
    return {"a": rows, "b": rows.withColumn("w", F.col("id") * 2)}


def test_versions_replace_tables_with_other_rows(spark, tmp_path):
    root = str(tmp_path / "r")
    assert versions.current(spark, root) is None
    with pytest.raises(ValueError):
        versions.read_version(spark, root, ["a"])
    first = versions.publish_version(pair(spark, 0), root)
    old = versions.read_version(spark, root, ["a", "b"])
    versions.publish_version(pair(spark, 1), root)
    assert versions.current(spark, root)[0] == 2
    new = versions.read_version(spark, root, ["a", "b"])
    assert [d.count() for d in (*old.values(), *new.values())] == [200, 200, 400, 400]
    assert versions.read_version(spark, root, ["b"], first)["b"].columns == ["id", "v", "w"]


def test_a_failed_run_is_never_seen(spark, tmp_path):
    root = str(tmp_path / "r")
    versions.publish_version(pair(spark, 0), root)

    def refuse(version):
        assert versions.read_version(spark, root, ["a"], version)["a"].count() == 400
        raise RuntimeError("checked and refused")

    with pytest.raises(RuntimeError):
        versions.publish_version(pair(spark, 1), root, refuse)
    assert versions.current(spark, root)[0] == 1 and versions.read_version(spark, root, ["a"])["a"].count() == 200


def test_readers_and_views_see_one_version_during_replacement(spark, tmp_path):
    root, seen, stop = str(tmp_path / "r"), [], threading.Event()
    versions.publish_version(pair(spark, 0), root)
    versions.create_views(spark, root, ["a", "b"], "tm_")
    joined = "SELECT count(*) AS n, count_if(a.v <> b.v) AS mixed FROM tm_a a JOIN tm_b b USING (id)"

    def read():
        while not stop.is_set():
            tables = versions.read_version(spark, root, ["a", "b"])
            row = tables["a"].select("id", "v").join(tables["b"].select("id", F.col("v").alias("u")), "id")
            seen.append(("folder", *row.agg(F.count(F.lit(1)), F.count_if(F.col("u") != F.col("v"))).first()))
            seen.append(("view", *spark.sql(joined).first()))

    reader = threading.Thread(target=read)
    reader.start()
    for k in range(1, 4):
        versions.publish_version(pair(spark, k), root)
    stop.set()
    reader.join()
    assert seen and all(mixed == 0 and n in (200, 400, 600, 800) for _, n, mixed in seen)
    assert spark.sql(joined).first()[0] == 800
    for name in ("tm_a", "tm_b"):
        spark.sql(f"DROP VIEW {name}")


def test_two_writers_leave_one_current_version(spark, tmp_path):
    root = str(tmp_path / "r")
    versions.switch(spark, root, "x")
    rows = [(2, "p", []), (2, "q", [])]  # both saw number 1
    spark.createDataFrame(rows, versions.POINTER).write.mode("append").parquet(f"{root}/versions")
    assert versions.current(spark, root) == (2, "q")


def test_a_view_prunes_to_the_current_version(spark, tmp_path):
    root = str(tmp_path / "r")
    for k in range(2):
        versions.publish_version(pair(spark, k), root)
    versions.create_views(spark, root, ["a"], "tp_")
    plan = spark.table("tp_a")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(version" in plan
    spark.sql("DROP VIEW tp_a")


def test_model_queries_fit_once_per_state_of_the_files(spark, monkeypatch):
    """The second query takes the stored fit; other settings or files make a new one."""
    fits = []
    inner = registry.training.compare
    monkeypatch.setattr(registry.training, "compare", lambda *a, **k: fits.append(1) or inner(*a, **k))
    monkeypatch.setattr(registry, "ENSEMBLES", registry.Settings(forest_trees=2, boosting_rounds=2, folds=2))
    i = Inputs(spark, "/root/testdata/sf0.001")
    first, features = registry._champion(i, (registry.FOREST,), cross_validate=False)
    again, _ = registry._champion(i, (registry.FOREST,), cross_validate=False)
    assert len(fits) == 1 and first.best == again.best == registry.FOREST
    p = [{r[0]: r[1] for r in registry.training.predict_all(x.champion, features).select("customer_id", "churn_probability").collect()} for x in (first, again)]
    assert p[0] == p[1]
    monkeypatch.setattr(Inputs, "fingerprint", lambda self: "other files")
    registry._champion(i, (registry.FOREST,), cross_validate=False)
    assert len(fits) == 2
