"""Windows longer than a block, percentiles and densities of continuous values, samples by digits."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from demandtide.operators import decompose, explore, quantiles, series, windows
from tests.conftest import ordered, season


@pytest.mark.parametrize("window", [1, 7, 50, 400])
def test_long_trailing_means_equal_short_ones(make_series, window):
    s = make_series({"a": season(300, 1), "b": season(130, 2)}).withColumn("y", F.when(F.col("idx") % 11 != 3, F.col("y")))
    one = ordered(windows.trailing_mean(s, ["k"], window), keys=("k", "idx"))
    many = ordered(windows.long_trailing_mean(s, ["k"], window, block=16), keys=("k", "idx"))
    assert list(many.columns) == list(one.columns)
    np.testing.assert_allclose(many.pred, one.pred, rtol=1e-9)
    np.testing.assert_allclose(ordered(windows.trailing_mean(s, ["k"], window, block=16), keys=("k", "idx")).pred, one.pred, rtol=1e-9)


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("period", [7, 24, 90])
def test_long_periods_equal_one_block(make_series, period, keys):
    s = make_series({"a": season(300, 1), "b": season(200, 2)} if keys else season(300))
    one, many = (ordered(decompose.decompose(s, keys, period, block=b), keys=(*keys, "idx")) for b in (4032, 3))
    np.testing.assert_allclose(many[["trend", "seasonal", "resid"]].astype(float), one[["trend", "seasonal", "resid"]].astype(float), rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("small", [quantiles.SMALL, 5])
def test_several_percentiles_in_passes(spark, monkeypatch, small):
    """Heavy tails, ties, groups beyond the bracket size; with brackets narrowed again and again."""
    monkeypatch.setattr(quantiles, "CELLS", 16 if small == 5 else quantiles.CELLS)
    rng = np.random.default_rng(2)
    groups = {"tail": rng.standard_cauchy(60_000) ** 3, "ties": rng.integers(0, 4, 50_000).astype(float), "few": np.array([3.0, 1.0, 2.0, np.nan]), "flat": np.full(100, 7.5), "two": np.array([1.0, 2.0])}
    pdf = pd.concat([pd.DataFrame({"k": k, "v": v}) for k, v in groups.items()])
    df = spark.createDataFrame(pdf).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    wanted = {"q0": 0.0, "q1": 0.25, "med": 0.5, "q3": 0.75, "q95": 0.95, "top": 1.0}
    got = {r["k"]: r for r in quantiles.exact_percentiles(df, ["k"], "v", wanted, small).collect()}
    assert set(got) == set(groups)
    for k, v in groups.items():
        np.testing.assert_allclose([got[k][n] for n in wanted], np.quantile(v[~np.isnan(v)], list(wanted.values())), rtol=1e-9)


def test_a_bracket_that_misses_is_replaced(spark, monkeypatch):
    """A sketch far too coarse: the answer is exact all the same."""
    monkeypatch.setattr(quantiles, "ACCURACY", 3)
    monkeypatch.setattr(quantiles, "MARGIN", 0.0)
    monkeypatch.setattr(quantiles, "SMALL", 12)
    values = np.random.default_rng(3).normal(size=5000)
    df = spark.createDataFrame(pd.DataFrame({"v": values}))
    got = quantiles.exact_percentiles(df, [], "v", {"a": 0.123, "b": 0.9}, 12).collect()[0]
    np.testing.assert_allclose([got.a, got.b], np.quantile(values, [0.123, 0.9]), rtol=1e-12)
    assert quantiles.exact_percentiles(df.limit(0), [], "v", {"a": 0.5}).collect()[0].a is None


def test_density_of_continuous_values(spark):
    """Within the stated bound of the plain sum over all values; far fewer cells than values."""
    rng = np.random.default_rng(4)
    v = np.concatenate([rng.normal(size=30_000), rng.exponential(size=10_000) * 5, [60.0]])
    df = spark.createDataFrame(pd.DataFrame({"y": v}))
    got = explore.density(df).orderBy("point").collect()
    h = v.std(ddof=1) * len(v) ** -0.2
    x = np.linspace(v.min(), v.max(), 200)
    plain = np.array([np.exp(-(((p - v) / h) ** 2) / 2).sum() for p in x]) / (len(v) * h * np.sqrt(2 * np.pi))
    np.testing.assert_allclose([r.x for r in got], x, rtol=1e-12)
    assert np.abs(np.array([r.density for r in got]) - plain).max() < 1e-6 / (h * np.sqrt(2 * np.pi))


def test_boxes_of_continuous_values(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"k": rng.integers(0, 3, 60_000), "v": rng.standard_t(2, 60_000)})
    got = {r["k"]: r for r in explore.box_statistics(spark.createDataFrame(pdf), {"k": F.col("k")}, value="v").collect()}
    for k, part in pdf.groupby("k"):
        q1, med, q3 = np.quantile(part.v, [0.25, 0.5, 0.75])
        inside = part.v[(part.v >= q1 - 1.5 * (q3 - q1)) & (part.v <= q3 + 1.5 * (q3 - q1))]
        np.testing.assert_allclose([got[k][c] for c in ("q1", "med", "q3", "whisker_lo", "whisker_hi", "n_out", "n")], [q1, med, q3, inside.min(), inside.max(), len(part) - len(inside), len(part)])


@pytest.mark.parametrize("slice_rows", [100_000, 10, 1])
@pytest.mark.parametrize("frac", [0.0, 0.1, 0.333, 0.5, 1.0])
def test_exact_sample_by_digits(spark, slice_rows, frac):
    """Repeated ids, rows alike in every column, negative ids; slices down to a row."""
    pdf = pd.DataFrame({"id": [*range(-300, 300), *[7] * 200, *[8] * 50], "x": [*range(600), *[1] * 200, *range(50)]})
    got = sorted((r.id, r.x) for r in series.sample_exact(spark.createDataFrame(pdf), "id", frac, slice_rows).collect())
    keep = round(frac * 850)
    assert len(got) == keep
    rank = pdf.assign(h=[(i * 2654435761) % 2**32 for i in pdf.id]).sort_values(["h", "id"])
    assert sorted(i for i, _ in got) == sorted(rank.id[:keep])
    have = pdf.value_counts()
    assert all(n <= have[k] for k, n in pd.Series(got).value_counts().items()) if got else keep == 0
