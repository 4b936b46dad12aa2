"""Threshold choice and classification quality from scored rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.running import running_totals


def _labelled(scored: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    y = F.col(label).cast("bigint")
    return scored.where(F.col(score).isNotNull() & F.col(label).isNotNull()).select(
        *by, F.col(score).cast("double").alias("score"), y.alias("pos"), (1 - y).alias("neg")
    )


def score_points(scored: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Per group and distinct score: positives and negatives with it, and with a larger one."""
    return running_totals(_labelled(scored, label, score, by), "score", ["pos", "neg"], by)


def precision_recall(scored: DataFrame, label: str, score: str) -> DataFrame:
    """Precision and recall when everything at or above a distinct score counts as positive."""
    points = score_points(scored, label, score)
    positives = _labelled(scored, label, score).agg(F.sum("pos")).scalar()
    tp = F.col("pos") + F.col("pos_above")
    called = tp + F.col("neg") + F.col("neg_above")
    return points.select(
        F.col("score").alias("threshold"),
        tp.alias("true_positives"),
        called.alias("called_positive"),
        (tp.cast("double") / called.cast("double")).alias("precision"),
        F.coalesce(
            F.try_divide(tp.cast("double"), positives.cast("double")), F.lit(1.0)
        ).alias("recall"),
    )


def f_beta(precision: Column, recall: Column, beta: float) -> Column:
    weight = float(beta) ** 2
    return (1 + weight) * precision * recall / (weight * precision + recall + 1e-9)


def best_threshold(scored: DataFrame, label: str, score: str, beta: float = 2.0) -> DataFrame:
    """The threshold with the largest F-beta, the lowest one on ties; one row."""
    curve = precision_recall(scored, label, score).withColumn(
        "f_beta", f_beta(F.col("precision"), F.col("recall"), beta)
    )
    best = F.max(
        F.struct(
            "f_beta",
            (-F.col("threshold")).alias("rank"),
            "threshold",
            "precision",
            "recall",
        )
    )
    return curve.agg(best.alias("b")).select("b.threshold", "b.precision", "b.recall", "b.f_beta")


def area_under_roc(scored: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact AUC: share of (churned, retained) pairs in the right order, ties half; one row, or one a group."""
    points = score_points(scored, label, score, by)
    pairs = F.col("neg").cast("double") * (F.col("pos_above") + F.col("pos") * 0.5)
    p, n = F.sum("pos").cast("double"), F.sum("neg").cast("double")
    return points.groupBy(*by).agg(F.try_divide(F.sum(pairs), p * n).alias("auc"))


def classification_report(
    scored: DataFrame, label: str, predicted: str, names: tuple[str, str] = ("Retained", "Churned")
) -> DataFrame:
    """Precision, recall, F1 and support per class, macro and weighted, plus accuracy.

    One pass counts the four outcomes; the rest is arithmetic on that row.
    """
    y, z = F.col(label) == 1, F.col(predicted) == 1
    outcome = scored.where(F.col(label).isNotNull() & F.col(predicted).isNotNull()).agg(
        F.count_if(y & z).alias("tp"),
        F.count_if(~y & z).alias("fp"),
        F.count_if(y & ~z).alias("fn"),
        F.count_if(~y & ~z).alias("tn"),
    )

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    def quality(tp: str, fp: str, fn: str) -> tuple[Column, Column, Column, Column]:
        hit, false, missed = F.col(tp), F.col(fp), F.col(fn)
        precision, recall = ratio(hit, hit + false), ratio(hit, hit + missed)
        return precision, recall, ratio(2 * hit, 2 * hit + false + missed), hit + missed

    neg = quality("tn", "fn", "fp")
    pos = quality("tp", "fp", "fn")
    everyone = neg[3] + pos[3]
    macro = [(a + b) / 2 for a, b in zip(neg[:3], pos[:3])]
    weighted = [ratio(a * neg[3] + b * pos[3], everyone) for a, b in zip(neg[:3], pos[:3])]
    right = ratio(F.col("tp") + F.col("tn"), everyone)
    lines = [
        (names[0], *neg),
        (names[1], *pos),
        ("accuracy", right, right, right, everyone),
        ("macro avg", *macro, everyone),
        ("weighted avg", *weighted, everyone),
    ]
    entries = [
        F.struct(
            F.lit(name).alias("label"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            support.cast("bigint").alias("support"),
        )
        for name, precision, recall, f1, support in lines
    ]
    return outcome.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


