"""Correlation inputs (FIXTURES.md section 5)."""

import pytest

from riverwatch.operators.analytics import rain_river_corr


def _corr(spark, rows):
    df = spark.createDataFrame(rows, "a double, b double")
    return rain_river_corr(df, "a", "b").first().correlation


def test_pairwise_nulls(spark):
    v = _corr(spark, [(1.0, 2.0), (2.0, 4.1), (3.0, 5.9), (None, 9.0)])
    assert v == pytest.approx(0.9990152631781918, abs=1e-12)


def test_empty_constant_single(spark):
    assert _corr(spark, []) is None
    assert _corr(spark, [(1.0, 2.0), (1.0, 3.0)]) is None
    assert _corr(spark, [(1.0, 2.0)]) is None


def test_matches_pandas(spark):
    import numpy as np
    rng = np.random.default_rng(7)
    a = rng.normal(size=500)
    b = a * 0.3 + rng.normal(size=500)
    v = _corr(spark, [(float(x), float(y)) for x, y in zip(a, b)])
    assert v == pytest.approx(float(np.corrcoef(a, b)[0, 1]), abs=1e-12)
