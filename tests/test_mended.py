"""Odd keys, odd times, gaps in predictions: cases in which a wrong answer once came out unseen."""

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from demandtide.operators.evaluate import compare_models, evaluate, on_common_rows, rank_by_rmse
from demandtide.operators.features import norm_params
from demandtide.operators.isolation import draw, isolation_forest, sample_windows
from demandtide.operators.lagmodels import lag_forecast
from demandtide.operators.sarima import sarima
from demandtide.operators.scores import widen_scores
from demandtide.operators.series import demand_series, rescale_sampled
from demandtide.operators.stationarity import adf_test
from demandtide.operators.trend import trend_forecast
from demandtide.sources.tables import read_norm_params, write_norm_params
from demandtide.streaming.hourly import closed_hours, run_once
from tests.conftest import season


def test_text_times_with_and_without_bounds(spark):
    log = spark.createDataFrame([("2024-01-01 00:10:00",), ("2024-01-01 01:10:00",), ("no time",), (None,), ("2024-01-02 00:00:00",)], "ts string")
    assert demand_series(log).agg(F.sum("y")).first()[0] == 3
    assert [r["y"] for r in demand_series(log, start="2024-01-01", end="2024-01-02").orderBy("idx").collect()] == [1, 1]


def test_keys_of_any_name(spark, make_series):
    table = make_series({"a": season(200), "b": season(200, 1)})
    plain = {(r["k"], r["idx"]): r["pred"] for r in trend_forecast(table, ["k"]).collect()}
    for name in ("event type", "class", "_1"):
        got = trend_forecast(table.withColumnRenamed("k", name), [name]).collect()
        assert {(r[name], r["idx"]): r["pred"] for r in got} == plain


def test_keys_named_like_a_series_column_are_refused(spark):
    log = spark.createDataFrame([("2024-01-01", 1)], "ts string, n int")
    with pytest.raises(ValueError, match="rename"):
        demand_series(log, keys=["n"])


def test_metrics_count_predicted_rows_only(spark):
    rows = [("m", 0, 1.0, 1.5), ("m", 1, 2.0, 2.0), ("m", 2, 3.0, 2.5), ("m", 3, 100.0, None), ("none", 0, 1.0, None)]
    metrics = evaluate(spark.createDataFrame(rows, "model string, idx long, actual double, pred double"))
    by = {r["model"]: r for r in rank_by_rmse(metrics).collect()}
    assert by["m"]["R2"] == 0.75 and by["m"]["rank"] == 1
    assert by["none"]["RMSE"] is None and by["none"]["rank"] == 2


def test_models_are_compared_on_shared_rows_of_their_kind(spark):
    rows = [("late", t, 1) for t in (2, 3)] + [("early", t, 1) for t in (1, 2, 3)] + [("far", t, t) for t in (1, 2, 3)]
    df = spark.createDataFrame([(m, t, 1.0, 2.0, h) for m, t, h in rows], "model string, ts long, actual double, pred double, horizon long")
    got = sorted((r["model"], r["ts"], r["forecast"]) for r in on_common_rows(df).collect())
    assert got == [("early", 2, "one step"), ("early", 3, "one step"), ("far", 1, "ahead"), ("far", 2, "ahead"), ("far", 3, "ahead"), ("late", 2, "one step"), ("late", 3, "one step")]


def test_no_model_and_no_key_vanishes_from_the_comparison(spark):
    """A key with one test row takes nothing from the others; a model without forecast is a row with its reason."""
    rows = [(k, m, t, h) for k, n in (("long", 20), ("one", 1)) for m, ahead in (("far", True), ("near", False)) for t in range(n) for h in [t + 1 if ahead else 1]]
    rows += [("long", "mean", t, 1) for t in range(3, 20)] + [("apart", "near", 0, 1), ("apart", "mean", 1, 1), ("apart", "far", 0, 1)]
    df = spark.createDataFrame([(k, m, t, float(t), t + 1.0, h) for k, m, t, h in rows], "k string, model string, ts long, actual double, pred double, horizon long")
    common = on_common_rows(df, ["k"]).groupBy("k", "forecast", "model").count().collect()
    assert {tuple(r) for r in common} == {("long", "ahead", "far", 20), ("long", "one step", "near", 17), ("long", "one step", "mean", 17), ("one", "ahead", "far", 1), ("one", "one step", "near", 1), ("apart", "ahead", "far", 1)}
    found = {(r["k"], r["model"]): r for r in compare_models(df, ["k"]).collect()}
    assert set(found) == {(k, m) for k in ("long", "one", "apart") for m in ("far", "near", "mean")}
    assert found["one", "mean"]["reason"] == "no forecast" and found["one", "mean"]["RMSE"] is None
    assert found["apart", "near"]["reason"] == found["apart", "mean"]["reason"] == "no common rows"
    assert found["long", "mean"]["reason"] is None and found["long", "mean"]["RMSE"] == 1.0 and found["long", "mean"]["forecast"] == "one step"
    assert len(compare_models(df.where("k = 'long'").drop("k")).collect()) == 3


def test_wide_scores_keep_fractions(spark):
    df = spark.createDataFrame([("m", 1, 2.0, 0.5), ("m", 2, 3.0, 0.5)], "method string, ts long, y double, score double")
    assert widen_scores(rescale_sampled(df, 0.3), ["m"]).agg(F.round(F.sum("trip_count"), 9)).first()[0] == round(5 / 0.3, 9)


def test_norm_parameters_keep_the_type_of_their_key(spark, make_series, tmp_path):
    series = make_series({"1": [1.0, 2.0, 4.0], "2": [2.0, 2.0, 3.0]}).withColumn("k", F.col("k").cast("bigint"))
    params = norm_params(series, ["k"])
    write_norm_params(params, f"{tmp_path}/p")
    back = read_norm_params(spark, f"{tmp_path}/p", series.select("k").schema)
    assert back.schema["k"].dataType.simpleString() == "bigint"
    assert sorted(back.select("k", "mean").collect()) == sorted(params.select("k", "mean").collect())


def test_stream_and_batch_agree_in_another_zone(spark, tmp_path):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        rows = [("2024-01-01 00:10:00", "a"), ("2024-01-01 00:50:00", None), ("2024-01-01 00:55:00", "a"), ("2024-01-01 05:00:00", "a")]
        spark.createDataFrame(rows, "t string, k string").select(F.col("t").cast("timestamp").alias("ts"), "k").write.parquet(f"{tmp_path}/in")
        log = spark.read.parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(log.schema).parquet(f"{tmp_path}/in")
        got = {(r["k"], r["ts"]): r["trip_count"] for r in run_once(closed_hours(stream, keys=["k"]), f"{tmp_path}/out").collect()}
        batch = {(r["k"], r["ts"]): r["y"] for r in demand_series(log, keys=["k"]).collect() if r["y"]}
        assert got == {("a", pd.Timestamp("2024-01-01 00:00:00").to_pydatetime()): 2}
        assert got.items() <= batch.items()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_trees_draw_windows_alike_at_every_size(spark, make_series):
    """Gaps to the next tree, drawn by one rule, also where far fewer windows than all are wanted."""
    series = make_series([float(i % 7) for i in range(3000)])
    for sample in (256, 8):
        got = sorted((r["tree"], r["idx"]) for r in sample_windows(series, [], 2977, 24, 20, sample, 42).select("tree", "idx").collect())
        missed, takes = math.log(1 - 1.3 * sample / 2977), []
        for i in range(23, 3000):
            tree, k = -1, 0
            while True:
                tree, k = tree + 1 + math.floor(math.log(max(draw(42, k, 0, i, 1), 1e-12)) / missed), k + 1
                if tree >= 20:
                    break
                takes.append((tree, i))
        # As many as one draw for each tree and window would give, about.
        assert abs(len(takes) / (20 * 1.3 * sample) - 1) < 0.25
        want = []
        for tree in range(20):
            want += [(tree, i) for i in sorted((i for t, i in takes if t == tree), key=lambda i: (draw(42, tree, 0, i, 2), i))[:sample]]
        assert got == sorted(want)
    assert isolation_forest(series, trees=5, sample=16).where("score > 0").count() == 2977


def test_no_key_vanishes_from_the_unit_root_test(spark, make_series):
    values = {"season": season(200), "late": [0.0] * 95 + [1.0] * 5, "edges": [1.0] + [0.0] * 98 + [1.0], "flat": [2.0] * 100, "short": [1.0, 2.0, 3.0]}
    rows = {r["k"]: r for r in adf_test(make_series(values), ["k"]).collect()}
    assert set(rows) == set(values)
    assert rows["season"]["reason"] is None and rows["season"]["pvalue"] is not None
    assert all(rows[k]["tau"] is None and rows[k]["usedlag"] is None and rows[k]["reason"] for k in ("late", "flat", "short"))


def test_idle_and_short_keys_keep_their_forecast_rows(spark, make_series):
    table = make_series({"busy": season(200), "idle": [3.0] * 160 + [4.0] * 40, "short": [1.0] * 8})
    lag = lag_forecast(table, "lr", ["k"]).where("k = 'idle'").agg(F.count("*"), F.min("pred"), F.max("pred")).first()
    assert lag[0] == 16 and abs(lag[1] - 3) < 1e-9 and abs(lag[2] - 3) < 1e-9
    short = sarima(table, ["k"]).where("k = 'short'").collect()
    assert [r["pred"] for r in short] == [None, None]
