"""Which inputs drive the predicted churn."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.ml.curve import area_under_roc
from tidemark.ml.preparation import VECTOR

ROWS_PER_EXCHANGE = 4096


def linear_importance(classifier, prepared: DataFrame, names: list[str]) -> DataFrame:
    """Mean absolute contribution coefficient * (x - mean x) over the rows, per feature.

    The contribution of a feature to a linear score against the average customer.
    """
    means = prepared.select(Summarizer.mean(F.col(VECTOR)).alias("m")).first()["m"]
    x = vector_to_array(VECTOR)
    contributions = [
        F.avg(F.abs(F.lit(float(b)) * (F.col("_x")[j] - F.lit(float(means[j]))))).alias(f"c{j}")
        for j, b in enumerate(classifier.coefficients)
    ]
    one_row = prepared.select(x.alias("_x")).agg(*contributions)
    entries = [
        F.struct(F.lit(name).alias("feature"), F.col(f"c{j}").alias("mean_abs_shap"))
        for j, name in enumerate(names)
    ]
    return one_row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def tree_importance(classifier, prepared: DataFrame, names: list[str]) -> DataFrame:
    """Share of the impurity decrease per feature, as learned by the trees."""
    shares = classifier.importances
    return prepared.sparkSession.createDataFrame(
        list(zip(names, shares)), "feature string, mean_abs_shap double"
    )


def driver_importance(classifier, prepared: DataFrame, names: list[str]) -> DataFrame:
    """Feature importance of any candidate, largest first."""
    linear = hasattr(classifier, "coefficients")
    out = (linear_importance if linear else tree_importance)(classifier, prepared, names)
    return out.orderBy(F.desc("mean_abs_shap"), "feature")


def _drawn(key: str, seed: int) -> Column:
    """A whole number fixed by key and seed: the first 60 bits of an MD5 digest."""
    text = F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def _with_partner(prepared: DataFrame, key: str, seed: int, exchange_rows: int) -> DataFrame:
    """Each row with the vector of another random row; every vector is handed out once.

    Rows are put into hash buckets of a few thousand and exchanged in a ring within the bucket,
    so no task sees more than one bucket at a time however many rows there are.
    """
    buckets = max(1, prepared.count() // exchange_rows)
    place = _drawn(key, seed)
    bucket = F.pmod(_drawn(key, seed + 1), F.lit(buckets))
    placed = prepared.withColumn("_b", bucket).withColumn("_h", place)
    ring = W.partitionBy("_b").orderBy("_h")
    whole = ring.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    x = vector_to_array(VECTOR)
    return placed.withColumn("_x", x).withColumn(
        "_other", F.coalesce(F.lead("_x").over(ring), F.first("_x").over(whole))
    )


def exchanged(prepared: DataFrame, names: list[str], label: str, key: str, seed: int, exchange_rows: int) -> DataFrame:
    """Each row once as it is (``feature`` empty) and once per feature with that entry of its partner."""
    paired = _with_partner(prepared, key, seed, exchange_rows).select(label, "_x", "_other")
    which = F.explode(F.array(*[F.struct(F.lit(j).alias("j"), F.lit(n).alias("feature")) for j, n in enumerate(["", *names], -1)]))
    swapped = F.transform("_x", lambda v, i: F.when(i == F.col("w.j"), F.get("_other", i)).otherwise(v))
    return paired.select(label, which.alias("w"), "_x", "_other").select(
        label, F.col("w.feature").alias("feature"), array_to_vector(swapped).alias(VECTOR)
    )


def auc_losses(scored: DataFrame, label: str, score: str) -> DataFrame:
    """Per feature, largest first: AUC of the untouched rows (``feature`` empty) less that of the exchanged ones."""
    aucs = area_under_roc(scored, label, score, ["feature"])
    base = F.max(F.when(F.col("feature") == "", F.col("auc"))).over(W.partitionBy())  # a row a feature
    losses = aucs.select("feature", (base - F.col("auc")).alias("auc_loss")).where(F.col("feature") != "")
    return losses.orderBy(F.desc("auc_loss"), "feature")


def permutation_importance(
    score: Callable[[DataFrame], DataFrame], prepared: DataFrame, names: list[str], label: str = "label",
    key: str = "customer_id", seed: int = 42, exchange_rows: int = ROWS_PER_EXCHANGE,
) -> DataFrame:
    """Loss of AUC when one feature is exchanged between rows; works for every model.

    ``score`` adds the probability ``p`` to rows with a vector. All features are exchanged and scored in one job,
    their AUCs are one grouped ranking. Partners come from the same hash bucket of about ``exchange_rows`` rows.
    """
    return auc_losses(score(exchanged(prepared, names, label, key, seed, exchange_rows)), label, "p")
