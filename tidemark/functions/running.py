"""Running totals over an ordered value, by group, as prefix sums over range partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.session import settle


def running_totals(
    df: DataFrame, value: str, measures: list[str], by: Sequence[str] = ()
) -> DataFrame:
    """Per group and distinct ``value``: its sums and, as ``<measure>_above``, the sums of all larger values.

    Rows are first added up per distinct value. The distinct values are dealt to partitions by ranges of
    (group, value), as many as the data fill, and stored with the number of their range; running sums are taken
    inside ranges, and what lies in earlier ranges of the group is added from one row per range. A group of any
    size is spread over its ranges. Missing values and groups with a missing key are left out.
    """
    by = list(by)
    known = F.col(value).isNotNull()
    for name in by:
        known = known & F.col(name).isNotNull()
    points = df.where(known).groupBy(*by, value).agg(*[F.sum(m).alias(m) for m in measures])
    ranged = points.repartitionByRange(*by, F.desc(value)).withColumn("_range", F.spark_partition_id())
    ranged = settle(ranged, "ranges")
    totals = ranged.groupBy(*by, "_range").agg(*[F.sum(m).alias(f"_{m}") for m in measures])
    earlier = W.partitionBy(*by).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *by, "_range", *[F.coalesce(F.sum(f"_{m}").over(earlier), F.lit(0)).alias(f"_{m}_off") for m in measures]
    )
    inside = W.partitionBy(*by, "_range").orderBy(F.desc(value)).rowsBetween(W.unboundedPreceding, -1)
    local = ranged.select("*", *[F.coalesce(F.sum(m).over(inside), F.lit(0)).alias(f"_{m}_in") for m in measures])
    above = [(F.col(f"_{m}_in") + F.col(f"_{m}_off")).alias(f"{m}_above") for m in measures]
    return local.join(offsets, [*by, "_range"]).select(*by, value, *measures, *above)
