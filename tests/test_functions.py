import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import binning as b
from tidemark.functions.lookup import attach
from tidemark.functions.numeric import clip, flag, mean, round_half_away, round_half_even
from tidemark.functions import quantiles
from tidemark.functions.quantiles import exact_quantiles, order_statistics, quantiles_of_counts
from tidemark.functions.running import running_totals
from tidemark.functions.text import title_case


def column(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def binned(spark, bins, values):
    return [r[0] for r in column(spark, values).select(bins.of(F.col("v"))).collect()]


@pytest.mark.parametrize(
    "bins, values, expected",
    [
        (b.RECENCY, [None, -1, 0, 30, 31, 90, 91, 180, 365, 366, 99999, 100000],
         [None, None, 5, 5, 4, 4, 3, 3, 2, 1, 1, None]),
        (b.FREQUENCY, [0, 1, 2, 3, 4, 7, 8, 15, 16], [1, 1, 2, 2, 3, 3, 4, 4, 5]),
        (b.RISK_TIER, [0.0, 0.3, 0.31, 0.55, 0.56, 1.0, None],
         ["LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", None]),
        (b.WISHLIST, [0, 1, 5, 6, 15, 16, 100, 101],
         ["0 items", "1–5", "1–5", "6–15", "6–15", "16+", "16+", None]),
        (b.REVIEW, [0, 0.1, 2, 2.1, 3, 4, 5],
         [None, "1–2 Poor", "1–2 Poor", "3 Neutral", "3 Neutral", "4 Good", "5 Excellent"]),
    ],
)
def test_bin_edges(spark, bins, values, expected):
    assert binned(spark, bins, [None if v is None else float(v) for v in values]) == expected


def test_bins_agree_with_pandas_cut(spark):
    values = [float(v) for v in np.linspace(-5, 450, 321)]
    theirs = pd.cut(pd.Series(values), bins=list(b.RECENCY.edges), labels=list(b.RECENCY.labels))
    ours = binned(spark, b.RECENCY, values)
    assert ours == [None if pd.isna(x) else int(x) for x in theirs]


def test_tenure_cohort(spark):
    df = column(spark, [None, 0, 90, 91, 365, 366, 730, 731], "int")
    got = [r[0] for r in df.select(b.tenure_cohort(F.col("v"))).collect()]
    assert got == ["2+ years", "0-3 months", "0-3 months", "3-12 months", "3-12 months",
                   "1-2 years", "1-2 years", "2+ years"]


def test_title_case_matches_python(spark):
    words = [" female", "MALE ", "e-mail o'neil", "élan ñandú-x", "USA", "a1b 2c", "\tx y\n", "", "pay_later",
             "formal fee f"]
    df = spark.createDataFrame([(w,) for w in words] + [(None,)], "v string")
    got = [r[0] for r in df.select(title_case("v")).collect()]
    assert got == [w.strip().title() for w in words] + [None]


def test_rounding(spark):
    row = column(spark, [2.5]).select(
        round_half_away(F.lit(2.5), 0), round_half_away(F.lit(-2.5), 0),
        round_half_even(F.lit(2.5), 0), round_half_even(F.lit(3.5), 0),
        round_half_away(F.lit(None).cast("double"), 2), round_half_away(F.lit(-0.001), 2),
    ).first()
    assert list(row) == [3.0, -3.0, 2.0, 4.0, None, 0.0]
    assert str(row[5]) == "0.0"


def test_flags_and_clip(spark):
    df = column(spark, [None, 1.0, 9.0])
    assert [r[0] for r in df.select(flag(F.col("v") > 2)).collect()] == [0, 0, 1]
    assert [r[0] for r in df.select(clip(F.col("v"), 2, 5)).collect()] == [None, 2.0, 5.0]
    assert column(spark, [None]).agg(mean(F.col("v"))).first()[0] is None


PROBS = [0.0, 0.2, 0.25, 0.5, 0.75, 0.8, 1.0]


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50), st.floats(-1e6, 1e6)), min_size=1, max_size=60))
def test_quantiles_equal_numpy(spark, values):
    present = [float(v) for v in values if v is not None]
    df = column(spark, [None if v is None else float(v) for v in values])
    rows = exact_quantiles(df, "v", PROBS).collect()
    if not present:
        assert rows[0]["n"] is None and set(rows[0]["quantiles"]) == {None}
        return
    assert rows[0]["n"] == len(present)
    np.testing.assert_allclose(rows[0]["quantiles"], np.quantile(present, PROBS), rtol=1e-12, atol=1e-9)


def test_quantiles_of_heavy_tails_and_repeats(spark):
    rng = np.random.default_rng(5)
    heavy = np.concatenate([np.full(4000, 7.0), rng.lognormal(3, 2, 8000), [1e12], -rng.lognormal(0, 3, 500)])
    rng.shuffle(heavy)
    df = spark.createDataFrame(pd.DataFrame({"v": heavy})).repartition(16)
    got = exact_quantiles(df, "v", PROBS[1:-1]).first()["quantiles"]
    np.testing.assert_allclose(got, np.quantile(heavy, PROBS[1:-1]), rtol=1e-12)


def test_quantiles_of_extreme_doubles(spark):
    """Neighbouring doubles, the largest ones, subnormals, both zeros, infinities and NaN."""
    close = [1.0 + k * 2.0**-52 for k in range(40)]
    values = [5e-324, -5e-324, 0.0, -0.0, 1.7e308, -1.7e308, 1.6e308, float("inf"), float("-inf"), *close]
    picked = order_statistics(column(spark, values), "v", [k / len(values) for k in range(1, len(values) + 1)]).first()["cuts"]
    assert picked == sorted(values)
    with_nan = column(spark, [*values, float("nan"), float("nan")])
    cuts = order_statistics(with_nan, "v", [0.5, 1.0]).first()["cuts"]
    assert cuts[0] == sorted(values)[25] and np.isnan(cuts[1])


def test_selection_never_orders_more_than_the_digits(spark, monkeypatch):
    """Ten times the rows: what the passes hand to the ordering task stays within the digits of a rank."""
    sizes = []
    inner = quantiles._counted

    def counted(*args):
        out = inner(*args)
        rows = out.groupBy(*[c for c in out.columns if c in ("_g", "g", "want")]).count()
        sizes.append(rows.agg(F.max("count")).first()[0] or 0)
        return out

    monkeypatch.setattr(quantiles, "_counted", counted)
    monkeypatch.setattr(quantiles, "DIGITS", 256)
    monkeypatch.setattr(quantiles, "PER_FACTOR", 16)
    for n in (20_000, 200_000):
        df = spark.range(n).select((F.rand(3) * 1000).alias("v"))
        frame = np.sort(df.toPandas().v.to_numpy())
        got = exact_quantiles(df, "v", [0.5]).first()["quantiles"]
        np.testing.assert_allclose(got, [np.quantile(frame, 0.5)], rtol=1e-12)
    assert max(sizes) <= 256 and len(sizes) <= 12


def test_quantiles_by_group_and_from_counts(spark):
    rng = np.random.default_rng(6)
    frame = pd.DataFrame({"g": rng.choice(["a", "b", None], 900, p=[0.6, 0.3, 0.1]), "v": rng.integers(0, 9, 900) * 0.5})
    df = spark.createDataFrame(frame, "g string, v double")
    expected = frame.dropna().groupby("g").v.quantile([0.25, 0.5]).unstack().to_numpy().tolist()
    for rows in (
        exact_quantiles(df, "v", [0.25, 0.5], by=["g"]),
        quantiles_of_counts(df.groupBy("g", "v").count(), "v", "count", [0.25, 0.5], by=["g"]),
    ):
        got = {r["g"]: r["quantiles"] for r in rows.collect()}
        assert [got["a"], got["b"]] == expected


def test_order_statistics(spark):
    df = spark.range(1, 1001).select(F.lit("x").alias("g"), F.col("id").cast("double").alias("v"))
    cuts = order_statistics(df, "v", [0.2, 0.5], by=["g"]).first()["cuts"]
    assert cuts == [200.0, 500.0]


def test_running_totals_equal_brute_force(spark):
    rng = np.random.default_rng(7)
    frame = pd.DataFrame({"s": np.round(rng.beta(2, 5, 6000), 3), "m": rng.integers(0, 4, 6000)})
    got = running_totals(spark.createDataFrame(frame), "s", ["m"]).toPandas().sort_values("s")
    points = frame.groupby("s").m.sum()
    np.testing.assert_array_equal(got.s, points.index)
    np.testing.assert_array_equal(got.m, points)
    np.testing.assert_array_equal(got.m_above, points[::-1].cumsum()[::-1] - points)


def test_lookup_is_joined_whole(spark):
    rows = spark.range(100).withColumn("k", F.col("id") % 5)
    lookup = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    assert attach(rows, lookup, ["k"]).where("w = 2 * k").count() == 100


def test_rounding_leaves_huge_values_alone(spark):
    row = spark.range(1).select(
        round_half_away(F.lit(2e17), 2), round_half_away(F.lit(-3e13), 6), round_half_away(F.lit(1e15 + 0.5), 0)
    ).first()
    assert row[:] == (2e17, -3e13, 1e15 + 1)
