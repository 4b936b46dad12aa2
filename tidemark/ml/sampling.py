"""Stratified splits, folds and class weights that stay exact and repeatable at any size.

A row's place is a hash of its key and a seed. The share that goes to each side of a split is cut
at order statistics of that hash per label, so the sizes are exact without ranking a label's rows
in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.lookup import attach
from tidemark.functions.numeric import round_half_even, rows
from tidemark.functions.quantiles import order_statistics

_SPAN = 2**52


def place(key: str, seed: int) -> Column:
    """Uniform number in [0, 1) fixed by key and seed."""
    return F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(_SPAN)).cast("double") / _SPAN


def _cut(df: DataFrame, key: str, label: str, fractions: list[float], seed: int) -> DataFrame:
    placed = df.withColumn("_place", place(key, seed))
    cuts = order_statistics(placed, "_place", fractions, by=[label]).select(label, "cuts")
    return attach(placed, cuts, [label], "inner")


def stratified_split(
    df: DataFrame, key: str, label: str, share: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(larger part, part of size round(share * n) per label); keys must be unique."""
    cut = _cut(df, key, label, [share], seed)
    drawn = F.col("_place") <= F.col("cuts")[0]
    return (
        cut.where(~drawn).select(*df.columns),
        cut.where(drawn).select(*df.columns),
    )


def stratified_folds(
    df: DataFrame, key: str, label: str, folds: int = 5, seed: int = 43, name: str = "fold"
) -> DataFrame:
    """Adds a fold number 0..folds-1; every label is spread evenly over the folds."""
    cut = _cut(df, key, label, [i / folds for i in range(1, folds)], seed)
    fold = F.lit(0)
    for i in range(folds - 1):
        fold = fold + (F.col("_place") > F.col("cuts")[i]).cast("int")
    return cut.select(*df.columns, fold.alias(name))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Per class: rows, balanced weight n / (2 * n_class), and the boosting weight.

    The boosting weight is the rounded ratio of negatives to positives for positives, else 1.
    """
    counted = df.where(F.col(label).isNotNull()).groupBy(label).agg(rows().alias("customers"))
    everyone = F.sum("customers").over(W.partitionBy())
    n = F.col("customers").cast("double")
    ratio = round_half_even((everyone - F.col("customers")).cast("double") / n, 1)
    return counted.select(
        label,
        "customers",
        (everyone.cast("double") / (2.0 * n)).alias("balanced_weight"),
        F.when(F.col(label) == 1, ratio).otherwise(F.lit(1.0)).alias("boosting_weight"),
    )
