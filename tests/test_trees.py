"""The shared-pass tree trainer: against plain Python, against Spark ML's ensembles, and its own promises."""

from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tidemark.ml import trees
from tidemark.ml.curve import area_under_roc

FOLDS = 3


def planted(n=1500, seed=1, features=6):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, features))
    x[:, 3] = rng.integers(0, 4, n)
    p = 1 / (1 + np.exp(-(2 * x[:, 0] + 1.5 * x[:, 1] * (x[:, 3] > 1) - 1)))
    return pd.DataFrame(
        {"customer_id": np.arange(n), "label": (rng.random(n) < p).astype(float), "fold": (np.arange(n) % (FOLDS + 1) - 1).astype("int32"), "x": list(x)}
    )


@pytest.fixture(scope="module")
def frame():
    return planted()


@pytest.fixture(scope="module")
def binned(spark, frame):
    return trees.bin_rows(spark.createDataFrame(frame), "customer_id", FOLDS, [0.0] * 6, 1, trees.TreeRules(bins=16, block_rows=200))


def blocks_of(binned):
    return [trees.Block(r.asDict(), binned.features, binned.models) for r in binned.blocks.collect()]


def test_bins_hold_every_row_once(binned, frame):
    rows = {k: b for r, block in zip(binned.blocks.collect(), blocks_of(binned)) for k, b in zip(r["keys"], block.bins)}
    assert sorted(rows) == frame.customer_id.tolist()
    expected = trees.bin_places(np.stack(frame.x), binned.edges)
    assert all((rows[k] == expected[k]).all() for k in rows)
    assert binned.tasks > 1 and [len(e) for e in binned.edges] == [15, 15, 15, 4, 15, 15]
    fits = [(frame.fold >= 0) & (frame.fold != f) for f in (*range(FOLDS), 99)]
    assert binned.counts.tolist() == [[(frame.label[f] == c).sum() for c in (0, 1)] for f in fits]


def plain_boosted_tree(bins, label, weight_rows, choice, depth, step, positive_weight):
    """One tree at margin 0, by recursion."""
    weight = np.where(label == 1, positive_weight, 1.0)
    g, h = np.rint(weight * (0.5 - label) * trees.UNIT) / trees.UNIT, np.rint(weight * 0.25 * trees.UNIT) / trees.UNIT
    out = {}

    def grow(node, rows, level):
        out[node] = -step * g[rows].sum() / (h[rows].sum() + 1)
        if level == depth:
            return
        best = (0.0, None)
        whole = g[rows].sum() ** 2 / (h[rows].sum() + 1)
        for j in choice:
            for cut in range(15):
                left = rows[bins[rows, j] <= cut]
                right = rows[bins[rows, j] > cut]
                if len(left) and len(right) and h[left].sum() >= 1 and h[right].sum() >= 1:
                    gain = g[left].sum() ** 2 / (h[left].sum() + 1) + g[right].sum() ** 2 / (h[right].sum() + 1) - whole
                    if gain > best[0] + 1e-12:
                        best = (gain, (j, cut))
        if best[1] is not None and best[0] > 1e-6:
            j, cut = best[1]
            grow(2 * node + 1, rows[bins[rows, j] <= cut], level + 1)
            grow(2 * node + 2, rows[bins[rows, j] > cut], level + 1)

    grow(0, np.flatnonzero(weight_rows), 0)
    return out


def test_first_boosted_tree_equals_recursion(binned):
    grown, _ = trees.grow_boosted(binned, 1, 3, 0.1, 0.75, 2.0, 42)
    whole = blocks_of(binned)
    bins, label, fold, uid = (np.concatenate([getattr(b, c) for b in whole]) for c in ("bins", "label", "fold", "uid"))
    for m in range(FOLDS + 1):
        rng = np.random.default_rng([42, m, 0])
        choice = np.sort(rng.permutation(6)[: round(0.75 * 6)])
        used = (fold >= 0) & (fold != m) & (trees.drawn(uid, 42, m, 0) < 0.75)
        expected = plain_boosted_tree(bins, label, used, choice, 3, 0.1, 2.0)
        reached = {0}
        for node in range(7):
            if node in reached and grown[m].feature[0, node] >= 0:
                reached |= {2 * node + 1, 2 * node + 2}
        assert reached == set(expected)
        assert all(grown[m].value[0, n] == pytest.approx(v, abs=1e-9) for n, v in expected.items())


def same(a, b):
    return all((x.feature == y.feature).all() and (x.cut == y.cut).all() and (x.value == y.value).all() for x, y in zip(a, b))


def test_trees_do_not_depend_on_partitions_or_on_stored_rounds(spark, frame, binned):
    forest = trees.grow_forest(binned, 3, 4, 7)
    boosted, scored = trees.grow_boosted(binned, 5, 3, 0.1, 0.8, 2.0, 7)
    shuffled = spark.createDataFrame(frame.sample(frac=1, random_state=2)).repartition(5)
    rules = trees.TreeRules(bins=16, block_rows=64, written_every=2, histogram_bytes=1 << 14, sums_left=2)
    other = trees.bin_rows(shuffled, "customer_id", FOLDS, [0.0] * 6, 1, rules)
    assert same(forest, trees.grow_forest(other, 3, 4, 7))
    again, rescored = trees.grow_boosted(other, 5, 3, 0.1, 0.8, 2.0, 7)
    assert same(boosted, again)
    p = [{r["customer_id"]: r["boosting"] for r in trees.scored_rows(s, "customer_id", None, True).collect()} for s in (scored, rescored)]
    assert p[0] == p[1] and len(p[0]) == len(frame)


def test_a_fold_never_sees_its_own_labels(spark, frame, binned):
    """Other labels in fold 1 change every model but the one that leaves fold 1 out."""
    turned = frame.assign(label=np.where(frame.fold == 1, 1 - frame.label, frame.label))
    other = trees.bin_rows(spark.createDataFrame(turned), "customer_id", FOLDS, [0.0] * 6, 1, trees.TreeRules(bins=16, block_rows=200))
    for grow in (lambda b: trees.grow_forest(b, 2, 3, 1), lambda b: trees.grow_boosted(b, 2, 3, 0.1, 0.8, 2.0, 1)[0]):
        for m, (a, b) in enumerate(zip(grow(binned), grow(other))):
            assert same([a], [b]) == (m == 1)


def test_missing_values_go_to_each_models_own_bin(spark):
    data = planted(400)
    data["x"] = [[None if k % 5 == 0 and j in (0, 3) else float(v) for j, v in enumerate(row)] for k, row in enumerate(data.x)]
    df = spark.createDataFrame(data, "customer_id long, label double, fold int, x array<double>")
    binned = trees.bin_rows(df, "customer_id", FOLDS, [0.1, 0, 0, 2.0, 0, 0], 3, trees.TreeRules(bins=8))
    values = np.array([[np.nan if v is None else v for v in row] for row in data.x])
    places = trees.bin_places(values, binned.edges)
    for m in range(FOLDS):
        own = places[(data.fold >= 0) & (data.fold != m)]
        median, ordinal = np.sort(own[own[:, 0] != 255, 0]), np.bincount(own[own[:, 3] != 255, 3])
        assert binned.default[m, 0] == median[(len(median) - 1) // 2] and binned.default[m, 3] == ordinal.argmax()
    assert binned.default[-1].tolist() == trees.bin_places(np.array([[0.1, 0, 0, 2.0, 0, 0]]), binned.edges)[0].tolist()
    forests = trees.grow_forest(binned, 3, 3, 1)
    scored = trees.scored_rows(binned, "customer_id", forests, False).collect()
    assert len(scored) == 400 and all(0 <= v <= 1 for r in scored for v in r["forest"])


def test_quality_is_that_of_spark_ml(spark, tmp_path):
    """Held-out AUC on a planted signal within 0.01 of Spark ML's forest and boosted trees of equal size."""
    data = planted(6000, seed=4, features=8)
    data["fold"] = np.where(np.arange(len(data)) % 3 == 0, -1, 0).astype("int32")
    df = spark.createDataFrame(data).cache()
    binned = trees.bin_rows(df, "customer_id", 0, [0.0] * 8, 0)
    forests = trees.grow_forest(binned, 40, 6, 42)
    _, boosted = trees.grow_boosted(binned, 40, 4, 0.1, 0.8, 1.0, 42)
    own = trees.scored_rows(boosted, "customer_id", forests, True).where("fold = -1")
    vectors = df.withColumn("features", array_to_vector("x")).coalesce(1)
    spark_ml = {
        "forest": RandomForestClassifier(numTrees=40, maxDepth=6, seed=42),
        "boosting": GBTClassifier(maxIter=40, maxDepth=4, stepSize=0.1, subsamplingRate=0.8, seed=42),
    }
    for name, model in spark_ml.items():
        ours = area_under_roc(own.withColumn("p", F.col(name)[0]), "label", "p").first()["auc"]
        model.fit(vectors.where("fold = 0")).write().save(f"{tmp_path}/{name}")
        fitted = (RandomForestClassificationModel if name == "forest" else GBTClassificationModel).load(f"{tmp_path}/{name}")
        theirs = fitted.transform(vectors.where("fold = -1")).withColumn("p", vector_to_array("probability")[1])
        theirs = area_under_roc(theirs, "label", "p").first()["auc"]
        assert ours > 0.8 and abs(ours - theirs) < 0.01, (name, ours, theirs)


def test_model_round_trip_and_importance(spark, binned, tmp_path):
    forests, (boosted, scored) = trees.grow_forest(binned, 4, 3, 5), trees.grow_boosted(binned, 4, 3, 0.2, 0.8, 1.0, 5)
    p = trees.scored_rows(scored, "customer_id", forests, True)
    rows = spark.createDataFrame(planted()).withColumn("features", array_to_vector("x")).repartition(3)
    for name, grown in (("forest", forests[-1]), ("boosting", boosted[-1])):
        model = trees.TreeModel(name, grown, binned.edges)
        model.save(spark, f"{tmp_path}/{name}")
        loaded = trees.TreeModel.load(spark, f"{tmp_path}/{name}")
        both = loaded.probabilities(rows, "features").join(p.select("customer_id", F.element_at(name, -1).alias("fit")), "customer_id")
        assert both.where("p <> fit").count() == 0 and both.count() == 1500
        assert sum(model.importances) == pytest.approx(1) and int(np.argmax(model.importances)) == 0


def test_degenerate_tables(spark):
    one = pd.DataFrame({"customer_id": [1, 2], "label": [1.0, 1.0], "fold": [0, 0], "x": [[1.0, 2.0], [1.0, 2.0]]})
    binned = trees.bin_rows(spark.createDataFrame(one.astype({"fold": "int32"})), "customer_id", 0, [1.0, 2.0], 0)
    forests, (boosted, _) = trees.grow_forest(binned, 2, 3, 1), trees.grow_boosted(binned, 2, 3, 0.1, 1.0, 1.0, 1)
    assert (forests[0].feature == -1).all() and (boosted[0].feature == -1).all()
    assert replace(binned.rules, bins=3).bins == 3
