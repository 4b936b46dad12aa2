"""Pearson correlations of column pairs and with the label."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import flag, round_half_away
from tidemark.operators.features import engagement_score

# Columns of the correlation report and its screening limits.
CORRELATED = (
    "age", "total_orders", "total_spend_usd", "avg_order_value_usd",
    "days_since_last_purchase", "reviews_given", "avg_review_score",
    "returns_made", "wishlist_items", "newsletter_subscribed",
    "tenure_days", "engagement_score", "churned",
)
KEEP_ABOVE = 0.05
COLLINEAR_ABOVE = 0.85

MERGED_TASKS = 64


def correlation_input(customers: DataFrame) -> DataFrame:
    """The numeric columns of the report, as double."""
    ready = customers.withColumn("engagement_score", engagement_score()).withColumn(
        "tenure_days", F.col("customer_tenure_days")
    )
    return ready.select(*[F.col(c).cast("double").alias(c) for c in CORRELATED])


class Moments:
    """Pairwise complete counts, means, variances and co-moments of all column pairs, as square matrices.

    Entry (i, j) is about column i over the rows that have both; two sets of rows are merged exactly.
    """

    def __init__(self, n: np.ndarray, mean: np.ndarray, spread: np.ndarray, together: np.ndarray):
        self.n, self.mean, self.spread, self.together = n, mean, spread, together

    @classmethod
    def of(cls, values: np.ndarray) -> Moments:
        """Of rows of values, NaN where missing; centred at the column means before multiplying."""
        there = ~np.isnan(values)
        count = np.maximum(there.sum(axis=0), 1)
        centre = np.where(there, values, 0.0).sum(axis=0) / count
        x, mask = np.where(there, values - centre, 0.0), there.astype(np.float64)
        n = mask.T @ mask
        mean = (x.T @ mask) / np.maximum(n, 1)
        return cls(n, mean + centre[:, None], (x**2).T @ mask - n * mean**2, x.T @ x - n * mean * mean.T)

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        apart, weight = other.mean - self.mean, self.n * other.n / np.maximum(n, 1)
        mean = np.where(self.n == 0, other.mean, self.mean + apart * other.n / np.maximum(n, 1))
        return Moments(
            n, mean, self.spread + other.spread + apart**2 * weight, self.together + other.together + apart * apart.T * weight
        )

    def pack(self) -> bytes:
        return np.stack([self.n, self.mean, self.spread, self.together]).tobytes()

    @classmethod
    def unpack(cls, raw: bytes, width: int) -> Moments:
        return cls(*np.frombuffer(raw, np.float64).reshape(4, width, width))

    def correlations(self) -> np.ndarray:
        """NaN where fewer than two rows have both columns or one of them does not vary."""
        scale = np.sqrt(np.maximum(self.spread, 0) * np.maximum(self.spread.T, 0))
        return np.where((self.n > 1) & (scale > 0), self.together / np.where(scale > 0, scale, 1), np.nan)


def moments(df: DataFrame, columns: tuple[str, ...]) -> Moments:
    """All pairs in one pass: a task adds up its batches, groups of tasks are merged, the rest reaches the driver."""
    width = len(columns)

    def packed(total: Moments) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([total.pack()], pa.binary())], names=["moments"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Moments.of(np.zeros((0, width)))
        for batch in batches:
            total += Moments.of(np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns]))
        yield packed(total)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Moments.of(np.zeros((0, width)))
        for batch in batches:
            for one in batch.column(0):
                total += Moments.unpack(one.as_py(), width)
        yield packed(total)

    groups = min(MERGED_TASKS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parts = df.select(*columns).mapInArrow(first, "moments binary").repartition(groups).mapInArrow(again, "moments binary")
    total = Moments.of(np.zeros((0, width)))
    for row in parts.collect():
        total += Moments.unpack(row["moments"], width)
    return total


def correlation_pairs(df: DataFrame, columns: tuple[str, ...] = CORRELATED) -> DataFrame:
    """Lower triangle: every later column against every earlier one, over rows having both; one pass over ``df``."""
    found = moments(df, columns).correlations()
    place = {c: k for k, c in enumerate(columns)}
    rows = [(b, a, float(found[place[b], place[a]])) for a, b in combinations(columns, 2)]
    long = df.sparkSession.createDataFrame(rows, "feature string, other string, r double")
    return long.select("feature", "other", round_half_away(F.expr("nanvl(r, NULL)"), 6).alias("r"))


def correlation_matrix(pairs: DataFrame, columns: tuple[str, ...] = CORRELATED) -> DataFrame:
    """The full symmetric matrix in long form, diagonal included."""
    mirrored = pairs.select(F.col("other").alias("feature"), F.col("feature").alias("other"), "r")
    spark = pairs.sparkSession
    diagonal = spark.createDataFrame([(c, c, 1.0) for c in columns], "feature string, other string, r double")
    return pairs.unionByName(mirrored).unionByName(diagonal)


def target_correlations(df: DataFrame, target: str = "churned") -> DataFrame:
    """Correlation of each column with the target, ascending; only these pairs are computed."""
    features = [c for c in df.columns if c != target]
    one_row = df.agg(*[F.corr(c, target).alias(c) for c in features])
    entries = ", ".join(f"named_struct('feature', '{c}', 'r', `{c}`)" for c in features)
    long = one_row.select(F.expr(f"inline(array({entries}))"))
    out = long.withColumn("r", round_half_away(F.col("r"), 6))
    return out.withColumn("keep", flag(F.abs("r") > KEEP_ABOVE)).orderBy("r", "feature")


def strongest(correlations: DataFrame) -> DataFrame:
    """The strongest positive and the strongest protective feature."""
    named = F.struct("r", "feature")
    best = correlations.where("r is not null").agg(
        F.max(named).alias("hi"), F.min(named).alias("lo")
    )
    return best.select(
        F.explode(
            F.array(
                F.struct(
                    F.lit("risk").alias("direction"),
                    F.col("hi.feature").alias("feature"),
                    F.col("hi.r").alias("r"),
                ),
                F.struct(
                    F.lit("protective").alias("direction"),
                    F.col("lo.feature").alias("feature"),
                    F.col("lo.r").alias("r"),
                ),
            )
        ).alias("e")
    ).select("e.*")


def collinear_pairs(pairs: DataFrame, limit: float = COLLINEAR_ABOVE) -> DataFrame:
    """Feature pairs so close that one of them could be dropped."""
    return pairs.where((F.col("r") > limit) & (F.col("feature") != "churned"))
