from functools import partial

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.ml import attribution, curve, sampling, training
from tidemark.ml.candidates import BOOSTING, FOREST, LOGISTIC, Settings
from tidemark.ml.preparation import VECTOR, fit_preparation

SMALL = Settings(forest_trees=10, boosting_rounds=5, folds=2)


@pytest.fixture(scope="module")
def features(spark):
    """600 customers; dormancy raises churn, some inputs are missing."""
    rng = np.random.default_rng(3)
    n = 600
    days = rng.integers(0, 400, n)
    p = 1 / (1 + np.exp(-(days - 280) / 40))
    data = pd.DataFrame(
        {
            "customer_id": np.arange(n),
            "churned": (rng.random(n) < p).astype(int),
            "days_since_last_purchase": days.astype(float),
            "age": rng.integers(18, 80, n),
            "avg_review_score": np.where(rng.random(n) < 0.3, np.nan, rng.random(n) * 5),
            "gender": rng.choice(["Female", "Male"], n),
        }
    )
    df = spark.createDataFrame(data)
    return df.withColumn("avg_review_score", F.expr("nullif(avg_review_score, double('NaN'))")).withColumn(
        "avg_review_score", F.when(~F.isnan("avg_review_score"), F.col("avg_review_score"))
    )


@pytest.fixture(scope="module")
def result(features):
    return training.compare(features, SMALL)


def test_split_is_exact_per_label_and_repeatable(features):
    counts = {r["churned"]: r["count"] for r in features.groupBy("churned").count().collect()}
    train, test = sampling.stratified_split(features, "customer_id", "churned", 0.2, 42)
    held = {r["churned"]: r["count"] for r in test.groupBy("churned").count().collect()}
    assert held == {c: int(np.floor(n * 0.2 + 0.5)) for c, n in counts.items()}
    ids = {r[0] for r in test.select("customer_id").collect()}
    again = sampling.stratified_split(features.repartition(7), "customer_id", "churned", 0.2, 42)[1]
    assert ids == {r[0] for r in again.select("customer_id").collect()}
    assert train.count() + test.count() == features.count()
    assert train.join(test, "customer_id").count() == 0


def test_folds_are_even_per_label(features):
    folded = sampling.stratified_folds(features, "customer_id", "churned", 5)
    sizes = folded.groupBy("churned", "fold").count().toPandas()
    for _, part in sizes.groupby("churned"):
        assert len(part) == 5 and part["count"].max() - part["count"].min() <= 1


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 4, "churned int")
    got = {r["churned"]: r for r in sampling.class_weights(df, "churned").collect()}
    assert (got[0]["balanced_weight"], got[1]["balanced_weight"]) == (pytest.approx(10 / 12), 1.25)
    assert (got[0]["boosting_weight"], got[1]["boosting_weight"]) == (1.0, 1.5)


@pytest.mark.parametrize("one_hot", [False, True])
def test_preparation(spark, one_hot):
    train = spark.createDataFrame(
        [(1.0, "b"), (None, "a"), (3.0, "b"), (8.0, None)], "x double, c string"
    )
    prep = fit_preparation(train, ("x",), ("c",), one_hot)
    new = spark.createDataFrame([(3.0, "a"), (None, None), (3.0, "new")], "x double, c string")
    got = [r[0] for r in prep.transform(new).select(vector_to_array(VECTOR)).collect()]
    filled = np.array([1.0, 3.0, 3.0, 8.0])
    z = (3.0 - filled.mean()) / filled.std(ddof=1)
    codes = [[1, 0], [0, 1], [0, 0]] if one_hot else [[0], [1], [-1]]
    np.testing.assert_allclose(got, [[z, *c] for c in codes])


def scored(spark, n=3000, digits=2, seed=4):
    rng = np.random.default_rng(seed)
    s = rng.random(n).round(digits)
    data = pd.DataFrame({"y": (rng.random(n) < s * 0.6).astype(int), "s": s})
    return data, spark.createDataFrame(data)


@pytest.mark.parametrize("digits", [1, 6])
def test_threshold_and_auc_equal_brute_force(spark, digits):
    data, df = scored(spark, digits=digits)
    best = curve.best_threshold(df, "y", "s", 2.0).first()
    options = []
    for t in sorted(data.s.unique()):
        called = data.s >= t
        tp = int(data.y[called].sum())
        precision, recall = tp / called.sum(), tp / data.y.sum()
        options.append((5 * precision * recall / (4 * precision + recall + 1e-9), -t))
    f, t = max(options)
    assert best["threshold"] == -t and best["f_beta"] == pytest.approx(f)
    pos, neg = data.s[data.y == 1].to_numpy(), data.s[data.y == 0].to_numpy()
    wins = (pos[:, None] > neg[None, :]).mean() + 0.5 * (pos[:, None] == neg[None, :]).mean()
    assert curve.area_under_roc(df, "y", "s").first()["auc"] == pytest.approx(wins)


def test_classification_report(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0), (0, 0), (None, 1)], "y int, z int")
    got = {r["label"]: r for r in curve.classification_report(df, "y", "z").collect()}
    assert got["Churned"]["precision"] == 0.5 and got["Churned"]["support"] == 2
    assert got["Retained"]["recall"] == pytest.approx(2 / 3)
    assert got["accuracy"]["f1"] == pytest.approx(0.6)
    assert got["macro avg"]["recall"] == pytest.approx((2 / 3 + 0.5) / 2)
    assert got["weighted avg"]["support"] == 5


def test_comparison_finds_the_signal(spark, result, features):
    table = {r["model"]: r for r in result.table(spark).collect()}
    assert set(table) == {LOGISTIC, FOREST, BOOSTING}
    assert all(r["test_auc"] > 0.8 and r["cv_auc"] > 0.8 for r in table.values())
    assert sum(r["champion"] for r in table.values()) == 1
    drivers = training.importance(result).collect()
    assert drivers[0]["feature"] == "days_since_last_purchase" and len(drivers) == 4
    report = {r["label"]: r for r in training.test_report(result).collect()}
    assert report["Churned"]["recall"] > 0.7
    score = partial(training.probability, result.champion.classifier)
    permuted = attribution.permutation_importance(score, result.prepared_test, result.champion.feature_names).collect()
    assert len(permuted) == 4
    assert permuted[0]["feature"] == "days_since_last_purchase" and permuted[0]["auc_loss"] > 0.2


def test_predictions_and_saved_model(spark, result, features, tmp_path):
    predictions = training.predict_all(result.champion, features)
    assert predictions.count() == features.count() == predictions.select("customer_id").distinct().count()
    assert predictions.where("churn_probability between 0 and 1 and risk_tier is not null").count() == features.count()
    training.save_model(result.champion, str(tmp_path))
    loaded = training.load_model(spark, str(tmp_path))
    assert loaded.threshold == result.champion.threshold and loaded.version == result.champion.version
    again = training.predict_all(loaded, features)
    assert again.exceptAll(predictions).count() == 0


def test_validation_selection(features):
    picked = training.compare(
        features, Settings(models=(LOGISTIC,)), selection="validation", cross_validate=False
    )
    assert picked.scores[LOGISTIC]["test_auc"] > 0.8 and picked.train.count() < 400
    with pytest.raises(ValueError):
        training.compare(features, SMALL, selection="other")
