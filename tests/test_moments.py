import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.operators import correlation


def frame(n=500, offset=1e6):
    rng = np.random.default_rng(2)
    a = rng.normal(size=n)
    x = pd.DataFrame({"a": a + offset, "b": 2 * a + rng.normal(size=n), "c": rng.normal(size=n), "d": np.full(n, 3.0)})
    return x.mask(pd.DataFrame(rng.random((n, 4)) < 0.2, columns=list("abcd")))


def test_pairs_equal_pandas_in_one_scan(spark):
    x = frame()
    df = spark.createDataFrame(x.astype(object).where(x.notna(), None), "a double, b double, c double, d double").repartition(7)
    got = {(r["feature"], r["other"]): r["r"] for r in correlation.correlation_pairs(df, ("a", "b", "c", "d")).collect()}
    expected = x.corr()
    assert len(got) == 6
    for (i, j), r in got.items():
        assert r is None if "d" in (i, j) else r == pytest.approx(expected.loc[i, j], abs=1e-6)


def test_degenerate_columns(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (None, 5.0)], "a double, b double")
    assert [r["r"] for r in correlation.correlation_pairs(df, ("a", "b")).collect()] == [None]
    assert [r["r"] for r in correlation.correlation_pairs(df.limit(0), ("a", "b")).collect()] == [None]


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 60), st.integers(0, 60), st.booleans())
def test_merging_equals_one_pass(cut, size, far):
    x = frame(60, 1e8 if far else 0.0).to_numpy()[:size]
    whole, merged = correlation.Moments.of(x), correlation.Moments.of(x[:cut]) + correlation.Moments.of(x[cut:])
    assert (whole.n == merged.n).all()
    for name in ("spread", "together"):
        assert np.allclose(getattr(whole, name), getattr(merged, name), rtol=1e-6, atol=1e-5)
