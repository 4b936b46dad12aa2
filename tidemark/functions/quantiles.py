"""Exact interpolated quantiles and order statistics by descending through counts per digit.

The wanted ranks are found like digits of a number. A first pass over the narrow column counts the values per
digit of a monotone logarithmic scale, with the smallest and largest value of each. For a rank whose digit holds
more than one value, the next pass counts the values between that smallest and largest per digit of a linear
scale of ``DIGITS`` steps, and so on; every pass narrows the range by the number of digits, so four or five
suffice for any doubles and one or two for usual ones. Any number of ranks share a pass. The counts are taken
before the shuffle, and what one task orders is at most the digits of one rank, however many rows there are.
Rounding decides only where values are counted apart: the scales are monotone, and the answer is a value that
was seen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.session import settle

DIGITS = 65_536
PER_FACTOR = 256  # digits of the first pass for each factor e
PICK = "struct<want int, rank bigint, lo double, hi double, before bigint, cnt bigint>"
GROUP = "_g"
UNDECIDED = "p.lo <> p.hi AND p.rank <> p.before AND p.rank <> p.before + p.cnt - 1"


def _known(by: list[str]) -> Column:
    known = F.lit(True)
    for name in by:
        known = known & F.col(name).isNotNull()
    return known


def _first_digit() -> Column:
    """Grows with ``_v``; infinities and NaN (above all numbers) have digits of their own."""
    scaled = f"CAST(signum(_v) * floor(ln(1D + abs(_v)) * {PER_FACTOR}) AS BIGINT)"
    return F.expr(
        f"CASE WHEN isnan(_v) THEN 1000000002 WHEN _v = double('Infinity') THEN 1000000001 "
        f"WHEN _v = double('-Infinity') THEN -1000000001 ELSE {scaled} END"
    )


def _counted(values: DataFrame, keys: list[str], digit: Column, *more: Column) -> DataFrame:
    return values.groupBy(*keys, digit.alias("_digit")).agg(
        F.min("_v").alias("lo"), F.max("_v").alias("hi"), F.count(F.lit(1)).alias("cnt"), *more
    )


def _located(counted: DataFrame, by: list[str], ranks: Sequence[str]) -> DataFrame:
    """Per group: ``_n`` and the digit of each wanted rank (SQL over ``_n``)."""
    upto = W.partitionBy(*by).orderBy("_digit").rowsBetween(W.unboundedPreceding, W.currentRow)
    running = counted.withColumn("before", F.sum("cnt").over(upto) - F.col("cnt")).withColumn(
        "_n", F.sum("cnt").over(W.partitionBy(*by))
    )
    picks = [
        F.expr(
            f"max(CASE WHEN before <= {rank} AND {rank} < before + cnt THEN named_struct('want', {k}, "
            f"'rank', CAST({rank} AS BIGINT), 'lo', lo, 'hi', hi, 'before', before, 'cnt', cnt) END)"
        )
        for k, rank in enumerate(ranks)
    ]
    return running.groupBy(*by).agg(F.max("_n").alias("_n"), F.array(*picks).cast(f"array<{PICK}>").alias("_picks"))


def _narrowed(values: DataFrame, state: DataFrame, by: list[str]) -> DataFrame:
    """One more digit for the ranks that are still undecided."""
    asked = state.select(*by, F.expr(f"filter(_picks, p -> {UNDECIDED})").alias("_open")).where("size(_open) > 0")
    held = values.join(asked, by).select(
        *by, "_v", F.explode(F.expr("filter(_open, p -> _v BETWEEN p.lo AND p.hi)")).alias("p")
    )
    share = F.expr(  # by halves where the range itself overflows
        "CASE WHEN p.hi - p.lo < double('Infinity') THEN (_v - p.lo) / (p.hi - p.lo) "
        "ELSE (_v / 2 - p.lo / 2) / (p.hi / 2 - p.lo / 2) END"
    )
    counted = _counted(
        held.withColumn("want", F.col("p.want")), [*by, "want"], F.floor(share * (DIGITS - 1)).cast("long"),
        F.min("p.rank").alias("rank"), F.min("p.before").alias("below"),
    )
    upto = W.partitionBy(*by, "want").orderBy("_digit").rowsBetween(W.unboundedPreceding, W.currentRow)
    before = F.col("below") + F.sum("cnt").over(upto) - F.col("cnt")
    hit = counted.withColumn("before", before).where("before <= rank AND rank < before + cnt")
    found = hit.groupBy(*by).agg(F.collect_list(F.struct("want", "rank", "lo", "hi", "before", "cnt")).alias("_new"))  # a row a rank
    newer = F.expr("transform(_picks, p -> coalesce(get(filter(_new, q -> q.want = p.want), 0), p))")
    merged = F.when(F.col("_new").isNull(), F.col("_picks")).otherwise(newer).cast(f"array<{PICK}>")
    return state.join(found, by, "left").select(*by, "_n", merged.alias("_picks"))


def _ranked(df: DataFrame, value: str, ranks: Sequence[str], by: list[str]) -> DataFrame:
    """Per group: ``_n`` and the array ``_at`` of the values at the zero-based ranks."""
    values = df.where(_known(by)).select(*by, F.col(value).cast("double").alias("_v")).where("_v is not null")
    values = values.withColumn("_v", F.expr("_v + 0D"))  # one zero
    keys = by or [GROUP]
    if not by:
        values = values.withColumn(GROUP, F.lit(0))

    def kept(state: DataFrame) -> DataFrame:
        # without groups the state is a single row; with groups it is as long as they are many
        return settle(state, "ranks") if by else state.sparkSession.createDataFrame(state.collect(), state.schema)

    state = kept(_located(_counted(values, keys, _first_digit()), keys, ranks))
    while not state.where(f"exists(_picks, p -> {UNDECIDED})").isEmpty():
        state = kept(_narrowed(values, state, keys))
    return _values_at(state, by)


def _values_at(state: DataFrame, by: list[str]) -> DataFrame:
    at = F.transform("_picks", lambda p: F.when(p["rank"] == p["before"], p["lo"]).otherwise(p["hi"]))
    out = state.select(*by, "_n", at.alias("_at"))
    if by:
        return out
    nothing = out.sparkSession.range(1).select(F.lit(None).cast("bigint").alias("_n"), F.array().cast("array<double>").alias("_at"))
    return out if not state.isEmpty() else nothing


def _both(probs: Sequence[float]) -> list[str]:
    """The two neighbouring ranks of each quantile."""
    at = [f"(double(_n - 1) * {float(p)!r}D)" for p in probs]
    return [r for a in at for r in (f"floor({a})", f"least(floor({a}) + 1, _n - 1)")]


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Linearly interpolated quantiles, one row per group: ``n`` and the array ``quantiles``.

    The arrays ``lower``, ``upper`` and ``fraction`` hold the neighbouring values and the position
    between them, from which the quantiles of any increasing function of the value follow.
    Missing values are ignored, groups with a missing key are dropped. ``df`` is read once a pass.
    """
    by = list(by)
    return _interpolate(_ranked(df, value, _both(probs), by), probs, by)


def quantiles_of_counts(
    counts: DataFrame, value: str, count: str, probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """The same for data already counted by value; meant for counts of known small size."""
    by = list(by)
    v = F.col(value).cast("double")
    points = (
        counts.where(F.col(value).isNotNull() & _known(by))
        .groupBy(*by, v.alias("_digit"))
        .agg(F.sum(count).alias("cnt"))
        .select(*by, "_digit", F.col("_digit").alias("lo"), F.col("_digit").alias("hi"), "cnt")
    )
    located = _located(points, by, _both(probs))
    at = F.transform("_picks", lambda p: p["lo"])
    return _interpolate(located.select(*by, "_n", at.alias("_at")), probs, by)


def _interpolate(ranked: DataFrame, probs: Sequence[float], by: list[str]) -> DataFrame:
    ids = range(len(probs))
    fraction = [f"(double(_n - 1) * {float(p)!r}D) - floor(double(_n - 1) * {float(p)!r}D)" for p in probs]
    arrays = {
        "quantiles": [f"get(_at, {2 * i}) + (get(_at, {2 * i + 1}) - get(_at, {2 * i})) * ({fraction[i]})" for i in ids],
        "lower": [f"get(_at, {2 * i})" for i in ids],
        "upper": [f"get(_at, {2 * i + 1})" for i in ids],
        "fraction": fraction,
    }
    return ranked.select(
        *by, F.col("_n").alias("n"), *[F.expr(f"array({', '.join(parts)})").alias(name) for name, parts in arrays.items()]
    )


def order_statistics(df: DataFrame, value: str, fractions: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Per group the value that has round(fraction * n) values at or below it: array ``cuts``."""
    by = list(by)
    ranks = [f"(greatest(floor(_n * {float(p)!r}D + 0.5D), 1) - 1)" for p in fractions]
    return _ranked(df, value, ranks, by).select(*by, F.col("_n").alias("n"), F.col("_at").alias("cuts"))


def quantile_edges(df: DataFrame, value: str, probs: Sequence[float]) -> Column:
    """Quantiles of one column as an array-valued scalar subquery."""
    return exact_quantiles(df, value, probs).select("quantiles").scalar()
