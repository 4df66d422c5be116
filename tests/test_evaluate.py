import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from demandtide.functions import labels
from demandtide.operators import evaluate as ev
from demandtide.operators import explore, folds, scores
from demandtide.operators import features as ft
from demandtide.operators.quantiles import exact_percentile
from demandtide.operators.windows import trailing_mean
from tests.conftest import season


def metrics_of(spark, y, p):
    df = spark.createDataFrame([("m", float(a), None if b is None else float(b)) for a, b in zip(y, p)], "model string, actual double, pred double")
    return ev.evaluate(df).collect()[0]


def test_metrics_match_their_formulas(spark):
    rng = np.random.default_rng(3)
    y, p = rng.poisson(2, 200).astype(float), rng.poisson(2, 200).astype(float)
    got = metrics_of(spark, y, p)
    nz, half = y != 0, (np.abs(y) + np.abs(p)) / 2
    want = [
        np.abs(y - p).mean(),
        np.sqrt(((y - p) ** 2).mean()),
        np.abs((y - p)[nz] / y[nz]).mean() * 100,
        (np.abs(y - p)[half != 0] / half[half != 0]).mean() * 100,
        1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum(),
    ]
    np.testing.assert_allclose([got.MAE, got.RMSE, got.MAPE, got.SMAPE, got.R2], want, rtol=1e-12)


def test_metrics_of_zeros_and_constants(spark):
    zero = metrics_of(spark, [0, 0, 0], [0, 0, 0])
    assert zero.MAPE is None and zero.SMAPE is None and zero.R2 == 1.0
    assert metrics_of(spark, [0, 0], [1, 1]).SMAPE == 200.0
    assert metrics_of(spark, [5, 5, 5], [5, 5, 5]).R2 == 1.0
    assert metrics_of(spark, [5, 5, 5], [5, 5, 6]).R2 == 0.0
    assert metrics_of(spark, [5], [5]).R2 is None


def test_r2_keeps_its_digits_far_from_zero(spark):
    y = 1e9 + np.arange(100.0)
    assert metrics_of(spark, y, y + 1).R2 == pytest.approx(1 - 100 / ((y - y.mean()) ** 2).sum(), abs=1e-9)


def test_head_alignment_shifts_late_predictions(make_series):
    s = make_series(np.arange(100.0))  # test rows 80..99
    preds = s.where("idx >= 85").select(F.lit("m").alias("model"), "ts", "idx", "n", F.col("y").alias("actual"), F.col("y").alias("pred"))
    assert ev.evaluate(preds).collect()[0].MAE == 0.0
    head = ev.align_heads(preds, s)
    assert head.count() == 15 and ev.evaluate(head).collect()[0].MAE == 5.0


def test_absent_models_are_passed_over(spark):
    wide = spark.createDataFrame([("2024-01-01 00:00", 1.0, 2.0, None)], "ts string, actual double, pred_a double, pred_b double")
    long = ev.melt_predictions(wide, ["a", "b", "c"])
    assert [(r.model, r.pred) for r in long.collect()] == [("a", 2.0)]


def test_ranking(spark):
    m = spark.createDataFrame([("a", 1.0, 5.0, 1.0, 0.1), ("b", 2.0, 4.0, 2.0, 0.9)], "model string, MAE double, RMSE double, MAPE double, R2 double")
    got = {(r.metric, r.model): r["rank"] for r in ev.rank_models(m).collect()}
    assert got["MAE", "a"] == 1 and got["RMSE", "b"] == 1 and got["R2", "b"] == 1 and got["R2", "a"] == 2
    assert [r.model for r in ev.rank_by_rmse(m).orderBy("rank").collect()] == ["b", "a"]


@pytest.mark.parametrize("n,expected", [
    (720, [(1, 360, 480), (2, 480, 600), (3, 600, 720)]),
    (11, [(1, 5, 6), (2, 6, 7), (3, 7, 8), (4, 8, 9), (5, 9, 10)]),
    (7, [(1, 3, 4), (2, 4, 5), (3, 5, 6), (4, 6, 7)]),
    (5, []),
    (1, []),
])
def test_folds(make_series, n, expected):
    s = make_series(season(n))
    assert [tuple(r) for r in folds.fold_table(s).orderBy("fold").collect()] == expected
    rows = s.withColumn("fold", folds.test_fold()).where("fold is not null").groupBy("fold").agg(F.min("idx"), F.max("idx") + 1)
    assert [tuple(r) for r in rows.orderBy("fold").collect()] == expected


def test_folds_of_given_size(make_series):
    got = folds.fold_table(make_series(season(100)), test_size=20).orderBy("fold").collect()
    assert [tuple(r) for r in got] == [(1, 50, 70), (2, 70, 90)]


def test_walk_forward_ways_agree(make_series):
    s = make_series({"a": season(480, 1), "b": season(600, 2)}).drop("cut")
    ma = lambda table, keys: trailing_mean(table, keys)

    def user(train: pd.DataFrame, test: pd.DataFrame):
        y = np.concatenate([train.y, test.y])
        return [y[max(0, i - 24) : i].mean() for i in range(len(train), len(y))]

    def table(df):
        return {(r.k, r.fold): round(r.rmse, 9) for r in df.collect()}

    copies = table(folds.walk_forward(s, ma, ["k"]))
    assert len(copies) == 6
    assert copies == table(folds.walk_forward(s, ma, ["k"], refit=False))
    assert copies == table(folds.walk_forward(s, folds.pandas_forecaster(user), ["k"]))
    single = folds.walk_forward(s.where("k = 'a'").drop("k"), folds.pandas_forecaster(user))
    assert {("a", r.fold): round(r.rmse, 9) for r in single.collect()} == {k: v for k, v in copies.items() if k[0] == "a"}


def test_golden_walk_forward(spark):
    from demandtide.plans.queries import overall
    from tests.conftest import SF_LARGER

    per_fold = folds.walk_forward(overall(spark, SF_LARGER), lambda t, k: trailing_mean(t, k))
    assert [round(r.rmse, 6) for r in per_fold.orderBy("fold").collect()] == [3.947525, 3.579013, 3.938573]
    mean = folds.summarize_folds(per_fold).collect()[0]
    assert (round(mean.mean_rmse, 6), round(mean.std_rmse, 6)) == (3.821704, 0.171647)


@pytest.mark.parametrize("q", [0.0, 0.05, 0.5, 0.95, 1.0])
def test_exact_percentile(spark, q):
    """One group far above the bracket size, one with heavy ties, tiny ones."""
    rng = np.random.default_rng(4)
    groups = {"large": rng.normal(size=120_000), "ties": rng.poisson(3, 90_000).astype(float), "small": rng.normal(size=17), "one": np.array([3.0])}
    pdf = pd.concat([pd.DataFrame({"k": k, "v": v}) for k, v in groups.items()])
    got = {r.k: r.threshold for r in exact_percentile(spark.createDataFrame(pdf), ["k"], "v", q).collect()}
    for k, v in groups.items():
        assert got[k] == pytest.approx(np.percentile(v, q * 100), rel=1e-12, abs=1e-12), k
    whole = exact_percentile(spark.createDataFrame(pdf), [], "v", q).collect()[0].threshold
    assert whole == pytest.approx(np.percentile(pdf.v, q * 100), rel=1e-12, abs=1e-12)


def test_percentile_of_nothing(spark):
    empty = spark.createDataFrame([], "k string, v double")
    assert exact_percentile(empty, ["k"], "v", 0.5).collect() == []


def test_display_threshold_uses_positive_scores_of_the_tail(make_series):
    score = np.concatenate([np.full(100, 99.0), np.zeros(10), np.arange(1.0, 21.0)])
    s = make_series(score).withColumn("score", F.col("y")).withColumn("method", F.lit("m"))
    got = scores.display_flags(s, rows=30).collect()
    want = np.percentile(np.arange(1.0, 21.0), 95)
    assert len(got) == 30 and sum(r.flag for r in got) == 1
    assert all(r.threshold == pytest.approx(want) for r in got)


def test_display_flags_without_positive_scores(make_series):
    s = make_series({"a": np.zeros(30), "b": np.arange(30.0)}).withColumn("score", F.col("y")).withColumn("method", F.lit("m"))
    got = scores.display_flags(s, ["k"]).groupBy("k").agg(F.count("*").alias("c"), F.sum(F.col("flag").cast("int")).alias("f")).orderBy("k").collect()
    assert [tuple(r) for r in got] == [("a", 30, 0), ("b", 30, 2)]


def test_constant_series(make_series):
    s = make_series(np.full(50, 5.0))
    assert {r.z for r in ft.normalize(s, ft.norm_params(s)).collect()} == {None}
    assert [tuple(r) for r in explore.histogram(s).collect()] == [(0, 5.0, 5.0, 50)]
    assert explore.density(s).count() == 0


def test_histogram_and_density_match_numpy(make_series):
    y = np.random.default_rng(5).poisson(20, 500).astype(float)
    s = make_series(y)
    want, edges = np.histogram(y, 50)
    got = explore.histogram(s).orderBy("bin").collect()
    assert [r.n for r in got] == want.tolist()
    np.testing.assert_allclose([r.lo for r in got], edges[:-1])
    d = explore.density(s).orderBy("point").collect()
    h = y.std(ddof=1) * len(y) ** -0.2
    x = np.linspace(y.min(), y.max(), 200)
    dens = np.exp(-0.5 * ((x[:, None] - y) / h) ** 2).sum(1) / (len(y) * h * np.sqrt(2 * np.pi))
    np.testing.assert_allclose([r.density for r in d], dens, rtol=1e-9)


def test_training_only_normalization(make_series):
    s = make_series(np.concatenate([np.arange(80.0), np.full(20, 1000.0)])).drop("cut")
    p = ft.norm_params(s, fit_on="train").collect()[0]
    assert (p["mean"], p["std"]) == (pytest.approx(39.5), pytest.approx(np.arange(80).std(ddof=1)))
    with pytest.raises(ValueError):
        ft.norm_params(s, fit_on="test")


def test_frames_and_labels(spark, make_series):
    s = make_series([1.0, 2.0, 3.0])
    holes = s.withColumn("y", F.when(F.col("idx") != 1, F.col("y")))
    assert [r.y for r in ft.drop_missing(holes).orderBy("idx").collect()] == [1.0, 3.0]
    assert ft.regression_frame(s).columns == ["ds", "y"] and ft.future_frame(s).columns == ["ds"]
    row = spark.range(1).select(
        labels.title(F.lit("lag_linear")).alias("t"), labels.last_part(F.lit("anomaly_score_vae")).alias("l"),
        labels.metric_line(F.lit("m"), F.lit(1.234), F.lit(5.0)).alias("m"),
    ).collect()[0]
    assert (row.t, row.l, row.m) == ("Lag Linear", "vae", f"{'m':<20}       1.23       5.00")


def test_horizons(make_series):
    s = make_series(season(50)).withColumn("pred", F.col("y")).where("idx >= cut")
    assert [r.horizon for r in ev.as_predictions(s, "m").orderBy("idx").collect()] == list(range(1, 11))
    assert {r.horizon for r in ev.as_predictions(s, "m", one_step=True).collect()} == {1}


@pytest.mark.parametrize("block, fan", [(4032, 64), (20, 2), (20, 3)])
def test_a_merged_model_equals_one_fitted_at_once(make_series, block, fan):
    """States merged level by level; phases without a value have no forecast."""
    values = {"a": season(700, 1), "b": season(130, 2), "tiny": [1.0] * 10}
    s = make_series(values).withColumn("y", F.when(F.col("idx") % 24 != 5, F.col("y")))
    got = folds.block_forecaster(folds.PhaseMeans(24), block, fan)(s, ["k"]).collect()
    for k, y in values.items():
        y, cut = np.asarray(y), int(len(y) * 0.8)
        idx = np.arange(len(y))
        for r in (r for r in got if r["k"] == k):
            train = y[:cut][(idx[:cut] % 24 == r["idx"] % 24) & (idx[:cut] % 24 != 5)]
            assert r["pred"] == (pytest.approx(train.mean()) if len(train) else None)
        assert sorted(r["idx"] for r in got if r["k"] == k) == list(range(cut, len(y)))


class _Ordered:
    """A model whose merge depends on the order of time: the last value and how many there were."""

    def start(self):
        return np.array([np.nan, 0.0])

    def update(self, state, idx, y):
        return np.array([y[-1] if len(y) else state[0], state[1] + len(y)])

    def merge(self, earlier, later):
        return np.array([earlier[0] if np.isnan(later[0]) else later[0], earlier[1] + later[1]])

    def finish(self, state):
        return state

    def predict(self, params, idx):
        return params[0] + params[1] * 1000 + 0 * idx


def test_states_are_merged_in_order(make_series):
    out = folds.block_forecaster(_Ordered(), 7, 2)(make_series(np.arange(500.0)), []).collect()
    assert {r["pred"] for r in out} == {399 + 400_000}
