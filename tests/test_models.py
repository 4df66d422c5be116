"""Models against plain numpy, planted signals, and one block against many."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandtide.operators import folds, isolation, lagmodels, reconstruction, sarima, smoothing, stationarity, trend
from demandtide.operators.windows import trailing_mean
from demandtide.plans.queries import KEY, by_type, overall
from tests.conftest import SF, SF_LARGER, ordered, rmse, season


@pytest.fixture(scope="module")
def planted(make_series):
    return make_series(season()).cache()


# --- unit root ---------------------------------------------------------------------

GOLDEN_ADF = {SF: (-5.331629, 19, 700, -3.439726, -2.865678, -2.568973), SF_LARGER: (-20.703502, 1, 718, -3.439490, -2.865574, -2.568918)}


@pytest.mark.parametrize("sf", [SF, SF_LARGER])
def test_adf_golden(spark, sf):
    r = stationarity.adf_test(overall(spark, sf)).collect()[0]
    assert (round(r.tau, 6), r.usedlag, r.nobs, round(r.cv1, 6), round(r.cv5, 6), round(r.cv10, 6)) == GOLDEN_ADF[sf]
    assert r.is_stationary and (sf != SF or r.pvalue == pytest.approx(4.71e-6, rel=1e-2))


def plain_adf(y):
    """The same test with numpy least squares, one regression per lag length."""
    n, top = len(y), stationarity.max_lag(len(y))

    def fit(lag, first):
        dy = np.diff(y)
        t = np.arange(first, n)
        x = np.column_stack([y[t - 1], np.ones(len(t))] + [dy[t - 1 - k] for k in range(1, lag + 1)])
        b, *_ = np.linalg.lstsq(x, dy[t - 1], rcond=None)
        ssr = ((dy[t - 1] - x @ b) ** 2).sum()
        return b, ssr, len(t), x

    scores = []
    for lag in range(top + 1):
        _, ssr, m, _ = fit(lag, top + 1)
        scores.append(m * (math.log(2 * math.pi) + math.log(ssr / m) + 1) + 2 * (lag + 2))
    best = int(np.argmin(scores))
    b, ssr, m, x = fit(best, best + 1)
    return b[0] / math.sqrt(ssr / (m - best - 2) * np.linalg.inv(x.T @ x)[0, 0]), best


@pytest.mark.parametrize("block", [64, 4032])
def test_adf_equals_least_squares(make_series, block):
    rng = np.random.default_rng(7)
    walk = np.cumsum(rng.normal(size=1000)) + 500
    ar = np.zeros(300)
    for i in range(2, 300):
        ar[i] = 0.4 * ar[i - 1] + 0.3 * ar[i - 2] + rng.normal()
    values = {"walk": walk, "ar": ar, "short": rng.normal(size=12), "constant": np.full(50, 5.0), "tiny": np.arange(4.0)}
    got = {r.k: r for r in stationarity.adf_test(make_series(values), ["k"], block=block).collect()}
    assert set(got) == set(values)
    assert all(got[k].tau is None and got[k].reason for k in ("constant", "tiny"))
    for k in ("walk", "ar", "short"):
        tau, lag = plain_adf(values[k])
        assert got[k].usedlag == lag and got[k].tau == pytest.approx(tau, rel=1e-7)
    assert not got["walk"].is_stationary and got["ar"].is_stationary


@pytest.mark.parametrize("keys", [["k"], []])
def test_lags_reach_over_several_blocks(make_series, keys):
    """Blocks shorter than the longest lag and than the head of a series."""
    values = {"a": season(500, 1), "b": season(90, 2), "c": [1.0, 2.0]}
    s = make_series(values if keys else values["a"])
    one, many = (sorted((tuple(r) for r in stationarity.adf_test(s, keys, block=b).collect()), key=repr) for b in (4032, 8))
    assert [r[len(keys) + 2] for r in one] == [r[len(keys) + 2] for r in many]
    for x, y in zip(one, many):
        assert [v for v in x if not isinstance(v, float)] == [v for v in y if not isinstance(v, float)]
        np.testing.assert_allclose([v for v in x if isinstance(v, float)], [v for v in y if isinstance(v, float)], rtol=1e-8)


def test_short_series_have_a_row_without_keys_too(make_series):
    assert [(r.tau, r.reason) for r in stationarity.adf_test(make_series([1.0, 2.0, 3.0])).collect()] == [(None, "too short")]
    plain = {r.k: r.tau for r in stationarity.dickey_fuller(make_series({"flat": [2.0] * 50, "walk": np.cumsum(np.random.default_rng(1).normal(size=60)), "one": [1.0]}), ["k"]).collect()}
    assert set(plain) == {"flat", "walk", "one"} and plain["flat"] is None and plain["one"] is None and plain["walk"] is not None


def test_p_values_at_the_critical_values():
    p = [stationarity.p_value(stationarity.CRITICAL[c][0]) for c in ("cv1", "cv5", "cv10")]
    assert p == [pytest.approx(0.00997, abs=1e-4), pytest.approx(0.05, abs=1e-4), pytest.approx(0.1001, abs=1e-4)]
    assert stationarity.p_value(3) == 1.0 and stationarity.p_value(-20) == 0.0


def test_dickey_fuller_golden(spark):
    got = {r.event_type: round(r.tau, 6) for r in stationarity.dickey_fuller(by_type(spark, SF_LARGER), KEY).collect()}
    assert got == {"click": -27.608501, "error": -25.610357, "purchase": -26.002203, "signup": -25.787917, "view": -27.362573}


# --- smoothing ---------------------------------------------------------------------


def test_smoothing_golden_state(spark):
    whole = by_type(spark, SF_LARGER).withColumn("cut", F.col("n"))
    got = {r.event_type: r for r in smoothing.fit_smoothing(whole, KEY, [(0.3, 0.05, 0.1)]).collect()}
    r = got["click"]
    assert [round(v, 6) for v in (r.level, r.trend, r.sse, r.season[0], r.season[23])] == [1.847844, -0.041814, 3001.667227, 0.222143, -0.045620]
    r = got["signup"]
    assert [round(v, 6) for v in (r.level, r.trend, r.sse, r.season[0], r.season[23])] == [3.540681, 0.040257, 2837.339430, -0.244880, -0.274510]


@pytest.mark.parametrize("block", [48, 72, 240])
def test_smoothing_blocks_equal_one_run(make_series, block):
    s = make_series({"a": season(700, 1), "b": season(100, 2), "short": season(40, 3)})
    one = ordered(smoothing.holt_winters(s, ["k"]), keys=("k", "idx"))
    many = ordered(smoothing.holt_winters(s, ["k"], block=block), keys=("k", "idx"))
    assert set(one.k) == {"a", "b"}
    np.testing.assert_allclose(many.pred, one.pred, rtol=1e-9)
    np.testing.assert_allclose(many.sse, one.sse, rtol=1e-9)
    fit1 = ordered(smoothing.smoothed(s, ["k"]), "pred", keys=("k", "idx"))
    fit2 = ordered(smoothing.smoothed(s, ["k"], block=block), "pred", keys=("k", "idx"))
    np.testing.assert_allclose(fit2, fit1, rtol=1e-9)


def test_smoothing_of_a_short_series_gives_nothing(make_series):
    assert smoothing.holt_winters(make_series(season(50))).count() == 0


# --- trend and waves ---------------------------------------------------------------


@pytest.mark.parametrize("block", [100, 4032])
def test_trend_equals_numpy_ridge(make_series, block):
    y = season(500)
    got = ordered(trend.trend_forecast(make_series(y), block=block)).pred
    cut = 400
    freqs, knots = np.asarray(trend._waves(trend.SEASONS)), 0.8 * np.arange(1, 26) / 25
    t = np.arange(500)

    def design(i):
        cols = [np.ones(len(i)), i / (cut - 1)]
        for f in freqs:
            cols += [np.sin(2 * np.pi * f * i), np.cos(2 * np.pi * f * i)]
        return np.column_stack(cols + [np.maximum(i / (cut - 1) - k, 0) for k in knots])

    x = design(t[:cut])
    bend = np.diag([0.0] * 16 + [10.0] * 25)
    beta = np.linalg.solve(x.T @ x + bend, x.T @ y[:cut])
    np.testing.assert_allclose(got, design(t[cut:]) @ beta, rtol=1e-7)


@pytest.mark.parametrize("block", [4032, 70])
def test_penalty_equals_refitting_every_fold(make_series, block):
    """Sums of products per stretch give what a ridge on each fold's own rows gives; the test part is not looked at."""
    rng = np.random.default_rng(6)
    bent = season(600) + np.maximum(np.arange(600) - 250, 0) * 0.3 + rng.normal(size=600) * 4
    values = {"bent": bent, "short": season(30), "other": np.concatenate([bent[:480], np.full(120, 1e6)])}
    got = {r.k: r for r in trend.fit_tuned_trend(make_series(values), ["k"], block=block).collect()}
    freqs, knots = np.asarray(trend._waves(trend.SEASONS)), 0.8 * np.arange(1, 26) / 25
    y, cut = bent[:480], 480
    x = trend._design(np.arange(cut), cut, freqs, knots)
    rmses = []
    for fold in range(5):
        a, z = 240 + fold * 80, 240 + (fold + 1) * 80
        if z > cut:
            break
        betas = [np.linalg.solve(x[:a].T @ x[:a] + np.diag([0.0] * 16 + [p] * 25), x[:a].T @ y[:a]) for p in trend.PENALTIES]
        rmses.append([np.sqrt(np.mean((y[a:z] - x[a:z] @ b) ** 2)) for b in betas])
    means = np.mean(rmses, axis=0)
    assert len(rmses) == 3
    np.testing.assert_allclose(got["bent"].rmses, means, rtol=1e-6)
    assert got["bent"].penalty == trend.PENALTIES[int(np.argmin(means))] == got["other"].penalty
    assert got["other"].slope == pytest.approx(got["bent"].slope)


def test_tuned_forecast_of_too_little(make_series):
    """Without a fold the middle penalty is taken."""
    got = trend.fit_tuned_trend(make_series([1.0, 2.0, 3.0, 4.0, 5.0])).collect()
    assert [(r.penalty, r.mean_rmse) for r in got] == [(10.0, None)]


# --- seasonal ARIMA ----------------------------------------------------------------


SEASONAL, PLAIN = sarima.default_orders(24)


def plain_errors(y, a, m, order):
    w = np.diff(y, order.d)
    for _ in range(order.seasonal_d):
        w = w[order.period :] - w[: -order.period]
    e = np.zeros(len(w))
    for i in range(len(w)):
        e[i] = w[i] - sum(a[j] * w[i - k] for j, k in enumerate(order.ar_lags) if i >= k) - sum(m[j] * e[i - k] for j, k in enumerate(order.ma_lags) if i >= k)
    return w, e


ORDERS = [SEASONAL, PLAIN, sarima.Order(1, 0, 1), sarima.Order(0, 1, 1, 0, 1, 1, 24), sarima.Order(3, 2, 0, 2, 0, 1, 7), sarima.Order(0, 0, 4), sarima.Order(2, 0, 0), sarima.Order(0, 1, 0)]


@pytest.mark.parametrize("order", ORDERS, ids=str)
def test_sarima_errors_equal_a_plain_loop(order):
    """Series of different lengths run abreast, over more than one piece of time."""
    ys = [season(200, 1), season(600, 2), season(256, 3)]
    sets = np.stack([sarima.candidates(np.full(order.dims, 0.1 * r), 1)[:4] for r in range(3)])
    sse, last = sarima.run_errors(order, ys, 0, 0, sets, np.zeros((3, 4, order.memory)))
    a, m = order.coefficients(sets)
    for r, y in enumerate(ys):
        for p in range(4):
            _, e = plain_errors(y, a[r, p], m[r, p], order)
            assert sse[r, p] == pytest.approx((e[order.memory :] ** 2).sum(), rel=1e-10)
            np.testing.assert_allclose(last[r, p], e[-order.memory :], rtol=1e-8, atol=1e-10)


@pytest.mark.parametrize("order", ORDERS, ids=str)
def test_sarima_candidates_are_stationary(order):
    """All roots of both lag polynomials, seasonal parts included, lie within the unit circle."""
    a, m = order.coefficients(sarima.candidates(np.zeros(order.dims), 0))
    for weights, lags, sign in ((a, order.ar_lags, -1), (m, order.ma_lags, 1)):
        for w in weights[::20]:
            poly = np.zeros(max(lags, default=0) + 1)
            poly[0] = 1
            np.add.at(poly, list(lags), sign * w)
            assert np.all(np.abs(np.roots(poly)) < 1)


@pytest.mark.parametrize("order, seasonal", [((1, 0, 1), None), ((0, 1, 1), (0, 1, 1, 24)), ((3, 1, 2), (1, 0, 1, 7)), ((0, 2, 1), None), ((0, 1, 0), None)])
def test_stated_orders_by_hand(make_series, order, seasonal):
    """Fit and forecast of any order equal a plain recursion; blocks and one run agree."""
    y = season(400)
    s = make_series(y)
    o = sarima.Order(*order, *(seasonal or ()))
    model = sarima.fit_sarima(s, orders=(o,)).collect()[0]
    got = ordered(sarima.sarima(s, order=order, seasonal_order=seasonal))
    a, m = (c[0] for c in o.coefficients(np.asarray([model.params])))
    w, e = plain_errors(y[:320], a, m, o)
    assert model.sse == pytest.approx((e[o.memory :] ** 2).sum())
    full, w, e = list(y[:320]), list(w), list(e)
    for _ in range(80):
        w.append(sum(a[j] * w[-k] for j, k in enumerate(o.ar_lags)) + sum(m[j] * e[-k] for j, k in enumerate(o.ma_lags)))
        e.append(0.0)
        full.append(w[-1] + sum(c * full[-k] for k, c in o.undo.items()))
    np.testing.assert_allclose(got.pred, full[320:], rtol=1e-8)
    many = ordered(sarima.sarima(s, order=order, seasonal_order=seasonal, block=130))
    np.testing.assert_allclose(many[["pred", "aic", "bic"]], got[["pred", "aic", "bic"]], rtol=1e-7)


def test_a_stated_order_finds_its_process(make_series):
    rng = np.random.default_rng(4)
    y = np.zeros(4000)
    shock = rng.normal(size=4000)
    for i in range(2, 4000):
        y[i] = 0.6 * y[i - 1] - 0.3 * y[i - 2] + shock[i]
    o = sarima.Order(2, 0, 0)
    model = sarima.fit_sarima(make_series(y), orders=(o,)).collect()[0]
    np.testing.assert_allclose(o.coefficients(np.asarray([model.params]))[0][0], [0.6, -0.3], atol=0.05)


def test_odd_orders_are_refused(make_series):
    for bad in (dict(order=(-1, 0, 0)), dict(order=(1, 0, 0), seasonal_order=(1, 0, 0, 1))):
        with pytest.raises(ValueError):
            sarima.sarima(make_series(season(50)), **bad)
    with pytest.raises(ValueError, match="block"):
        sarima.sarima(make_series(season(50)), block=20)


def test_sarima_blocks_equal_one_run(make_series):
    s = make_series({"a": season(700, 1), "b": season(300, 2)})
    one = ordered(sarima.sarima(s, ["k"]), keys=("k", "idx"))
    many = ordered(sarima.sarima(s, ["k"], block=250), keys=("k", "idx"))
    np.testing.assert_allclose(many[["pred", "aic", "bic"]], one[["pred", "aic", "bic"]], rtol=1e-7)


def test_sarima_forecast_by_hand(make_series):
    y = season(400)
    s = make_series(y)
    model = sarima.fit_sarima(s).collect()[0]
    got = ordered(sarima.sarima(s)).pred.to_numpy()
    a, m = (c[0] for c in SEASONAL.coefficients(np.asarray([model.params])))
    w, e = plain_errors(y[:320], a, m, SEASONAL)
    assert model.sse == pytest.approx((e[26:] ** 2).sum())
    full, w, e = list(y[:320]), list(w), list(e)
    for _ in range(80):
        w.append(sum(a[j] * w[-k] + m[j] * e[-k] for j, k in enumerate((1, 2, 24, 25, 26))))
        e.append(0.0)
        full.append(full[-1] + w[-1] + full[-24] - full[-25])
    np.testing.assert_allclose(got, full[320:], rtol=1e-8)


def test_short_series_fall_back(make_series):
    s = make_series({"simple": season(60), "none": season(5), "full": season(200)})
    got = {r.k: (len(r.params)) for r in sarima.fit_sarima(s, ["k"]).collect()}
    assert got == {"simple": 2, "full": 6}
    assert sarima.sarima(s, ["k"]).where("k = 'simple'").count() == 12


# --- all forecasters ---------------------------------------------------------------


@pytest.mark.parametrize("forecaster", [sarima.sarima, smoothing.holt_winters, trend.trend_forecast, lagmodels.lag_forecast])
def test_planted_season_is_found(planted, forecaster):
    average = rmse(trailing_mean(planted).where("idx >= cut"))
    assert average > 6
    s = planted.drop("cut") if forecaster is lagmodels.lag_forecast else planted
    assert rmse(forecaster(s)) < 1.4


@pytest.mark.parametrize("name", ["rf", "gbt"])
def test_tree_learners(planted, name):
    out = lagmodels.lag_forecast(planted.drop("cut"), name)
    assert out.count() == 192 - 24 and rmse(out) < 4


def test_many_keys_equal_one(make_series):
    """A forecast of a series does not depend on the others beside it."""
    s = make_series({"a": season(300, 1), "b": 3 * season(400, 2)})
    alone = s.where("k = 'b'").drop("k")
    for f in (sarima.sarima, smoothing.holt_winters, trend.trend_forecast):
        both = ordered(f(s, ["k"]).where("k = 'b'"), "pred")
        np.testing.assert_allclose(both, ordered(f(alone), "pred"), rtol=1e-7)


@pytest.mark.parametrize("f", [smoothing.holt_winters, trend.trend_forecast])
def test_forecasters_walk_forward(make_series, f):
    scores = folds.walk_forward(make_series(season(600)).drop("cut"), f).collect()
    assert len(scores) == 3 and all(r.rmse < 2.5 for r in scores)


def test_training_history(make_series):
    h = lagmodels.training_history(make_series(season(300)).drop("cut")).collect()
    boost = [r.loss for r in h if r.model == "gbt" and r.split == "train"]
    assert len(boost) == 20 and boost[-1] < boost[0]
    steps = [r.loss for r in h if r.model == "lr_steps"]
    assert steps[-1] <= steps[0] and {r.split for r in h} == {"train", "test"}


# --- detectors ---------------------------------------------------------------------

SPIKES = (300, 700)


@pytest.fixture(scope="module")
def spiky(make_series):
    y = season()
    y[SPIKES[0]] += 40
    y[SPIKES[1]] -= 40
    return make_series(y).drop("cut").cache()


def top_share(scored, touched):
    w = ordered(scored.where("idx >= 23"))
    hit = set(w.idx[w.score > np.percentile(w.score, 95)])
    return len(hit & touched) / len(touched)


TOUCHED = {i for s in SPIKES for i in range(s, s + 24)}


def test_patterns_find_spikes(spiky):
    assert top_share(reconstruction.pattern_scores(spiky), TOUCHED) >= 0.9


def test_sequence_finds_spikes(spiky):
    assert top_share(lagmodels.sequence_scores(spiky), TOUCHED) >= 0.9


@pytest.mark.parametrize("block", [100, 4032])
def test_patterns_equal_svd(spiky, block):
    y = ordered(spiky).y.to_numpy()
    x = np.lib.stride_tricks.sliding_window_view((y - y.mean()) / y.std(ddof=1), 24)
    x = x - x.mean(axis=0)
    axes = np.linalg.svd(x, full_matrices=False)[2][:8]
    want = ((x - (x @ axes.T) @ axes) ** 2).mean(axis=1)
    got = ordered(reconstruction.pattern_scores(spiky, block=block)).score.to_numpy()
    assert np.all(got[:23] == 0)
    np.testing.assert_allclose(got[23:], want, rtol=1e-8, atol=1e-10)


def plain_forest_score(x, seed, trees=100, size=256):
    """An isolation forest written as recursion over tuples."""
    rng = np.random.default_rng(seed)
    total = np.zeros(len(x))

    def run(sample, rows, depth):
        if depth >= 8 or len(sample) <= 1 or np.all(sample.max(0) == sample.min(0)):
            total[rows] += depth + isolation.average_path(len(sample))
            return
        f = rng.choice(np.flatnonzero(sample.max(0) > sample.min(0)))
        c = rng.uniform(sample[:, f].min(), sample[:, f].max())
        run(sample[sample[:, f] < c], rows[x[rows, f] < c], depth + 1)
        run(sample[sample[:, f] >= c], rows[x[rows, f] >= c], depth + 1)

    for _ in range(trees):
        run(x[rng.choice(len(x), min(size, len(x)), replace=False)], np.arange(len(x)), 0)
    return 2 ** (-total / trees / isolation.average_path(min(size, len(x))))


def test_forest_scores_like_a_plain_one(spiky):
    got = ordered(isolation.isolation_forest(spiky)).score.to_numpy()
    x = np.lib.stride_tricks.sliding_window_view(ordered(spiky).y.to_numpy(), 24)
    a, b = plain_forest_score(x, 1), plain_forest_score(x, 2)
    assert np.all(got[:23] == 0)
    # As close to a plain forest as two plain forests are to each other.
    assert np.abs(got[23:] - a).mean() < 1.5 * np.abs(a - b).mean()
    assert np.corrcoef(got[23:], a)[0, 1] > np.corrcoef(a, b)[0, 1] - 0.1


def test_forest_finds_a_strange_day(make_series):
    y = 50 + np.random.default_rng(0).normal(size=960)
    y[480:504] += 30
    assert top_share(isolation.isolation_forest(make_series(y).drop("cut")), set(range(490, 518))) >= 0.9


def test_forest_does_not_depend_on_partitions(spark, spiky):
    a = ordered(isolation.isolation_forest(spiky), "score")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        b = ordered(isolation.isolation_forest(spiky.repartition(5)), "score")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    np.testing.assert_array_equal(a, b)


def test_forest_samples_are_bounded(make_series):
    s = make_series(np.zeros(60_000)).drop("cut")
    for windows in (59_977, 59_977 * 10):  # the second count stands for a far larger table
        chosen = isolation.sample_windows(s, [], windows, 24, 100, 256, 42)
        r = chosen.agg(F.count("*").alias("c"), F.max("turn").alias("t"), F.countDistinct("tree", "idx").alias("d")).collect()[0]
        assert r.c == r.d and r.t <= 256 and r.c > 2000
    full = isolation.sample_windows(s, [], 59_977, 24, 100, 256, 42).groupBy("tree").count().agg(F.min("count")).collect()[0][0]
    assert full >= 250


def test_forest_on_few_windows(make_series):
    got = ordered(isolation.isolation_forest(make_series(season(30)).drop("cut")))
    assert len(got) == 30 and (got.score[23:] > 0).all()
    with pytest.raises(ValueError):
        isolation.isolation_forest(make_series(season(10)).drop("cut"))


def test_forest_with_keys_ignores_scale(make_series):
    y = season(400)
    s = make_series({"a": y, "b": 1000 * y + 7}).drop("cut")
    got = ordered(isolation.isolation_forest(s, ["k"]), "k", "score", keys=("k", "idx"))
    np.testing.assert_allclose(got[got.k == "a"].score, got[got.k == "b"].score, rtol=1e-6)
