import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from demandtide.operators import windows as wi
from demandtide.operators.decompose import centered_trend, decompose
from demandtide.operators.features import with_split
from demandtide.operators.scores import window_mean_error
from tests.conftest import ordered, season


@pytest.fixture(scope="module")
def two(make_series):
    rng = np.random.default_rng(1)
    return make_series({"a": rng.poisson(5, 301), "b": rng.poisson(9, 777)}).cache()


@pytest.mark.parametrize("block", [24, 25, 100, 4032])
def test_blocks_equal_the_plain_window(two, block):
    w = Window.partitionBy("k").orderBy("idx").rowsBetween(-24, -1)
    plain = ordered(two.withColumn("pred", F.avg("y").over(w)), keys=("k", "idx"))
    cut = ordered(wi.trailing_mean(two, ["k"], block=block), keys=("k", "idx"))
    assert len(cut) == len(plain)
    np.testing.assert_allclose(cut.pred.to_numpy(float), plain.pred.to_numpy(float), rtol=1e-12, equal_nan=True)


def test_long_series_without_key(make_series):
    y = np.random.default_rng(2).normal(size=100_000)
    got = ordered(wi.trailing_mean(make_series(y))).pred.to_numpy(float)
    sums = np.concatenate([[0], np.cumsum(y)])
    i = np.arange(1, len(y))
    want = (sums[i] - sums[np.maximum(i - 24, 0)]) / np.minimum(i, 24)
    assert np.isnan(got[0])
    np.testing.assert_allclose(got[1:], want, atol=1e-9)


def test_no_single_partition_without_key(make_series):
    plan = wi.trailing_mean(make_series(season(100)))._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


@pytest.mark.parametrize("block", [50, 4032])
def test_supervised_windows_stay_in_their_split(make_series, block):
    y = np.arange(200.0)
    got = ordered(wi.supervised_windows(with_split(make_series(y).drop("cut")), block=block))
    assert sorted(got[got.split == "train"].idx) == list(range(24, 160))
    assert sorted(got[got.split == "test"].idx) == list(range(184, 200))
    assert all(list(x) == list(range(i - 24, i)) for x, i in zip(got.x, got.idx))


@pytest.mark.parametrize("n,windows", [(1, 0), (23, 0), (24, 1), (47, 24)])
def test_reconstruction_windows(make_series, n, windows):
    got = ordered(wi.reconstruction_windows(make_series(np.arange(float(n)))))
    assert len(got) == windows
    assert all(list(x) == list(range(i - 23, i + 1)) for x, i in zip(got.x, got.idx))


def test_windows_counts_at_defaults(make_series):
    s = with_split(make_series(np.zeros(720)).drop("cut"))
    by = {r["split"]: r["count"] for r in wi.supervised_windows(s).groupBy("split").count().collect()}
    assert by == {"train": 552, "test": 120}
    assert wi.reconstruction_windows(s).count() == 697


@pytest.mark.parametrize("period,block", [(24, 24), (24, 4032), (7, 10)])
def test_trend_at_block_edges(make_series, period, block):
    y = season(200)
    got = ordered(centered_trend(make_series(y), period=period, block=block)).trend.to_numpy(float)
    half = period // 2
    weights = np.ones(2 * half + 1)
    if period % 2 == 0:
        weights[[0, -1]] = 0.5
    want = np.convolve(y, weights / period, "valid")
    assert np.isnan(got[:half]).all() and np.isnan(got[-half:]).all()
    np.testing.assert_allclose(got[half:-half], want, rtol=1e-12)


def test_decomposition_recovers_the_season(make_series):
    n = 960
    got = ordered(decompose(make_series(season(n))), "trend", "seasonal", "resid", "observed")
    want = 10 * np.sin(2 * np.pi * np.arange(n) / 24)
    assert np.abs(got.seasonal - want).max() < 0.6
    whole = got.dropna()
    np.testing.assert_allclose(whole.trend + whole.seasonal + whole.resid, whole.observed, rtol=1e-12)


def test_short_series_have_no_decomposition(make_series):
    assert decompose(make_series({"a": np.ones(47), "b": np.ones(48)}), ["k"]).select("k").distinct().collect() == [("b",)]


def test_packed_blocks(make_series):
    y = np.arange(250.0)
    got = wi.pack_blocks(make_series(y), before=30, block=100).orderBy("blk").collect()
    assert [(r.blk, r["at"], len(r["values"])) for r in got] == [(0, 0, 100), (1, 70, 130), (2, 170, 80)]
    assert all(r["values"] == [float(v) for v in range(r["at"], r["at"] + len(r["values"]))] for r in got)


def test_last_rows(make_series):
    assert [r.idx for r in wi.last_rows(make_series(np.arange(10.0)), 3).orderBy("idx").collect()] == [7, 8, 9]


def test_scores_before_the_first_window_are_zero(make_series):
    errors = make_series(season(60)).withColumn("err", F.lit(2.0))
    got = ordered(window_mean_error(errors, "m"), "score").score.tolist()
    assert got == [0.0] * 23 + [2.0] * 37
