"""Right-closed binning, as labels and as ordinals."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bins:
    """Edges ``e0 < e1 < ...`` with one label per interval ``(e[i], e[i+1]]``."""

    edges: tuple[float, ...]
    labels: tuple
    include_lowest: bool = False

    def __post_init__(self):
        if len(self.edges) != len(self.labels) + 1:
            raise ValueError("one more edge than labels is needed")

    def of(self, c: Column) -> Column:
        """Label of the bin holding ``c``; null when missing or outside."""
        below = c < self.edges[0] if self.include_lowest else c <= self.edges[0]
        out = F.when(below, F.lit(None))
        for upper, label in zip(self.edges[1:], self.labels):
            out = out.when(c <= upper, F.lit(label))
        return out

    def dimension(self, spark: SparkSession, name: str) -> DataFrame:
        """All labels with their order, so that empty bins can be reported."""
        rows = [(str(label), i) for i, label in enumerate(self.labels)]
        return spark.createDataFrame(rows, f"`{name}` string, bucket_order int")


def cut_at(c: Column, upper_edges: Sequence[Column], labels: Sequence) -> Column:
    """Bin by computed upper edges (quantiles); the last bin takes what is left.

    Tied edges simply leave a bin empty.
    """
    out = F.when(c.isNull(), F.lit(None))
    for edge, label in zip(upper_edges, labels[:-1]):
        out = out.when(c <= edge, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


# Bin edges and labels of the retention reports.
RECENCY = Bins((-1, 30, 90, 180, 365, 99999), (5, 4, 3, 2, 1))
FREQUENCY = Bins((-1, 1, 3, 7, 15, 99999), (1, 2, 3, 4, 5))
RISK_TIER = Bins((0.0, 0.30, 0.55, 1.0), ("LOW", "MEDIUM", "HIGH"), include_lowest=True)
WISHLIST = Bins((-1, 0, 5, 15, 100), ("0 items", "1–5", "6–15", "16+"))
REVIEW = Bins((0, 2, 3, 4, 5), ("1–2 Poor", "3 Neutral", "4 Good", "5 Excellent"))
RETURNS = Bins((-1, 0, 1, 2, 100), ("0 returns", "1 return", "2 returns", "3+ returns"))
AGE = Bins((0, 25, 35, 45, 60, 100), ("18–25", "26–35", "36–45", "46–60", "60+"))
SPEND_QUARTILES = ("Q1 Low", "Q2 Mid-Low", "Q3 Mid-High", "Q4 High")
AGE_QUARTILES = ("young adult", "adult", "middle aged", "senior")
TENURE_COHORTS = ((90, "0-3 months"), (365, "3-12 months"), (730, "1-2 years"))
TENURE_REST = "2+ years"
ENGAGEMENT_LABELS = ("0 — None", "1 — Low", "2 — Medium", "3 — High")


def tenure_cohort(days: Column) -> Column:
    """Age of the relationship; an unknown start falls into the last cohort."""
    out = None
    for limit, label in TENURE_COHORTS:
        out = F.when(days <= limit, label) if out is None else out.when(days <= limit, label)
    return out.otherwise(TENURE_REST)
