"""Mergeable distinct counts: who was active in a month, stored once, merged for any longer period.

Exact counts are bitmaps: a customer is a bit, 32,768 of them to a block, and a period's bitmap is the union of
its months' bitmaps. Ids that are not small whole numbers are numbered first (``numbered``), so that blocks are
full. Estimates are sketches of fixed size with bounded error, for keys that nobody wants to number. Months are
written once and never read again as facts: a year is twelve rows a block, not its orders.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.session import settle

SKETCH_BITS = 12  # standard error about 1.04 / sqrt(2 ** 12), 1.6 %


def numbered(keys: DataFrame, key: str) -> DataFrame:
    """(key, number): distinct keys numbered from 0 without gaps, counted within ranges of the key and offset by range."""
    ranged = keys.select(key).where(F.col(key).isNotNull()).distinct().repartitionByRange(key)
    ranged = settle(ranged.withColumn("_range", F.spark_partition_id()), "numbered")
    earlier = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)  # a row a range
    offsets = ranged.groupBy("_range").count().select(
        "_range", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_before")
    )
    place = F.row_number().over(W.partitionBy("_range").orderBy(key)) - 1
    return ranged.withColumn("_place", place).join(offsets, "_range").select(
        key, (F.col("_place") + F.col("_before")).alias("number")
    )


def monthly_bitmaps(orders: DataFrame, number: str, date: str = "order_date") -> DataFrame:
    """(year, month, block, members): a bitmap per month and block of numbers; missing numbers or dates are left out.

    The bitmap of a month and block is built up before the shuffle, so a month with very many orders is cheap.
    """
    known = orders.where(F.col(number).isNotNull() & F.col(date).isNotNull())
    return known.groupBy(
        F.year(date).alias("year"), F.month(date).alias("month"), F.bitmap_bucket_number(F.col(number)).alias("block")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(number))).alias("members"))


def monthly_sketches(orders: DataFrame, key: str, date: str = "order_date", bits: int = SKETCH_BITS) -> DataFrame:
    """(year, month, sketch) of any key."""
    known = orders.where(F.col(key).isNotNull() & F.col(date).isNotNull())
    return known.groupBy(F.year(date).alias("year"), F.month(date).alias("month")).agg(
        F.hll_sketch_agg(F.col(key), F.lit(bits)).alias("sketch")
    )


def quarter(month: Column) -> Column:
    return F.ceil(month / 3).cast("int")


def members(bitmaps: DataFrame, *period: str) -> DataFrame:
    """Distinct members of each period (of everything if none is named), from the stored months."""
    merged = bitmaps.groupBy(*period, "block").agg(F.bitmap_count(F.bitmap_or_agg("members")).alias("_n"))
    return merged.groupBy(*period).agg(F.sum("_n").alias("unique_customers"))


def estimates(sketches: DataFrame, *period: str) -> DataFrame:
    return sketches.groupBy(*period).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def active_periods(bitmaps: DataFrame, sketches: DataFrame, tolerance: float = 0.06) -> DataFrame:
    """Exact members per month, quarter, year and in all, and whether the sketch agrees within ``tolerance``.

    Every figure is merged from the monthly rows: (period, label, unique_customers, estimate_agrees).
    """
    month, quarterly = F.format_string("%d-%02d", "year", "month"), F.format_string("%d-Q%d", "year", "quarter")
    levels = {
        "month": (("year", "month"), month), "quarter": (("year", "quarter"), quarterly),
        "year": (("year",), F.col("year").cast("string")), "all": ((), F.lit("all")),
    }
    with_quarter = [df.withColumn("quarter", quarter(F.col("month"))) for df in (bitmaps, sketches)]
    parts = []
    for name, (keys, label) in levels.items():
        exact, about = members(with_quarter[0], *keys), estimates(with_quarter[1], *keys)
        both = exact.join(about, list(keys)) if keys else exact.join(about)  # without keys: one row each
        near = F.abs(F.col("estimate") - F.col("unique_customers")) <= F.greatest(F.lit(1.0), F.col("unique_customers") * tolerance)
        parts.append(both.select(
            F.lit(name).alias("period"), label.alias("label"), "unique_customers", near.alias("estimate_agrees")
        ))
    return reduce(DataFrame.unionByName, parts)
