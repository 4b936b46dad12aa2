"""Trees grown by tasks that hold all rows: the same trees as by passes, in a few jobs."""

import numpy as np
import pandas as pd
import pytest

from tidemark.ml import training, trees

KINDS = "customer_id long, label double, fold int, x array<double>"


def table(spark, n=2500, features=7, folds=3):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(n, features)), 2)
    x[:, -1] = rng.integers(0, 5, n)
    gaps = rng.random((n, features)) < 0.1
    data = pd.DataFrame({"customer_id": np.arange(n) // 2, "label": (rng.random(n) < 1 / (1 + np.exp(1 - 2 * x[:, 0]))).astype(float)})
    data["fold"] = (rng.integers(0, max(1, folds) + 1, n) - 1).astype("int32")
    data["x"] = [[None if gap else float(v) for v, gap in zip(*row)] for row in zip(x, gaps)]
    data["customer_id"] = data.customer_id.astype(object).where(data.index > 20, None)  # keys repeat or are missing
    return spark.createDataFrame([tuple(r) for r in data.itertuples(index=False)], KINDS)


def equal(a, b):
    names = ("feature", "cut", "value", "gain")
    return len(a) == len(b) and all(np.array_equal(getattr(x, k), getattr(y, k)) for x, y in zip(a, b) for k in names)


@pytest.mark.parametrize("folds", [0, 3])
def test_whole_trees_equal_those_of_passes(spark, folds):
    df, filled = table(spark, folds=folds), [0.0] * 6 + [2.0]
    whole, passes = (
        trees.bin_rows(df, "customer_id", folds, filled, 1, trees.TreeRules(bins=16, block_rows=300, whole_bytes=size, chunk_rows=1000))
        for size in (1 << 20, 0)
    )
    assert whole.in_one_task and not passes.in_one_task
    assert equal(trees.grow_forest(whole, 9, 5, 3), trees.grow_forest(passes, 9, 5, 3))
    (a, scored), (b, expected) = (trees.grow_boosted(x, 12, 4, 0.2, 0.7, 2.5, 3) for x in (whole, passes))
    assert equal(a, b) and (a[-1].feature >= 0).sum() > 12
    found = [sorted(map(repr, trees.scored_rows(x, "customer_id", None, True).collect())) for x in (scored, expected)]
    assert found[0] == found[1] and len(found[0]) == 2500


def test_a_fit_of_few_rows_needs_few_jobs(spark):
    binned = trees.bin_rows(table(spark), "customer_id", 3, [0.0] * 7, 1)
    context = spark.sparkContext
    context.setJobGroup("few jobs", "")
    try:
        trees.grow_forest(binned, 30, 4, 3)
        trees.grow_boosted(binned, 30, 4, 0.1, 0.8, 1.0, 3)
        assert len(context.statusTracker().getJobIdsForGroup("few jobs")) < 10  # once a job a level or more
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_rows_above_the_bound_are_grown_by_passes(spark):
    df = table(spark, n=500)
    for size, expected in ((500 * 7, True), (500 * 7 - 1, False)):
        assert trees.bin_rows(df, "customer_id", 3, [0.0] * 7, 1, trees.TreeRules(whole_bytes=size)).in_one_task is expected


def test_a_task_without_rows_grows_leaves(spark):
    binned = trees.bin_rows(table(spark).where("fold < 0"), "customer_id", 2, [0.0] * 7, 1)
    assert binned.in_one_task and all((t.feature == -1).all() for t in trees.grow_forest(binned, 2, 3, 1))
    assert all((t.feature == -1).all() for t in trees.grow_boosted(binned, 2, 3, 0.1, 0.8, 1.0, 1)[0])


def test_a_stored_comparison_reads_only_the_models_asked_for(spark, monkeypatch):
    read = []
    monkeypatch.setattr(training, "load_model", lambda spark, folder: read.append(folder) or folder.upper())
    stored = training.StoredModels(spark, {"a": "one", "b": "two"})
    result = training.Comparison({"a": {"test_auc": 0.5, "cv_auc": None}, "b": {"test_auc": 0.7, "cv_auc": 0.6}}, stored, "b", None, None, None)
    rows = [tuple(r) for r in result.table(spark).collect()]
    assert rows == [("a", 0.5, None, False), ("b", 0.7, 0.6, True)] and list(result.fitted) == ["a", "b"] and read == []
    assert result.champion == result.champion == "TWO" and read == ["two"]
