"""The query catalogue: name to ``f(spark, sf_dir) -> DataFrame``.

Doubles are rounded to six places, so that another engine's last digits do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandtide.functions import labels
from demandtide.functions.calendar import floor_to_bucket
from demandtide.operators import evaluate as ev
from demandtide.operators import descent, explore, folds, scores
from demandtide.operators import features as ft
from demandtide.operators import series as se
from demandtide.operators import windows as wi
from demandtide.operators import lagmodels as lm
from demandtide.operators.decompose import decompose
from demandtide.operators.isolation import isolation_forest as score_by_forest
from demandtide.operators.quantiles import exact_percentiles
from demandtide.operators.reconstruction import pattern_scores
from demandtide.operators.sarima import sarima
from demandtide.operators.smoothing import holt_winters, smoothed
from demandtide.operators.stationarity import adf_test, dickey_fuller
from demandtide.operators.trend import trend_forecast
from demandtide.plans.models import forecast_all
from demandtide.session import scratch_dir
from demandtide.sources import tables as tb
from demandtide.streaming.gapless import run_gapless
from demandtide.streaming.hourly import closed_hours, run_once

KEY = ["event_type"]


def r6(name: str, col: Column | None = None, places: int = 6) -> Column:
    return F.round(F.col(name) if col is None else col, places).alias(name)


def overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly demand of the whole event log."""
    return se.demand_series(tb.table(spark, sf_dir, "events"))


def by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly demand per event type."""
    return se.demand_series(tb.table(spark, sf_dir, "events"), keys=KEY)


def kept(table: DataFrame) -> DataFrame:
    """A table that several passes read: written once, so what leads to it runs once."""
    return tb.write_and_read(table, scratch_dir(table.sparkSession, "kept"))


def trips() -> Column:
    return F.col("y").cast("bigint").alias("trip_count")


# --- counts and series -------------------------------------------------------------


def hourly_demand(spark, sf_dir):
    return overall(spark, sf_dir).select("ts", "idx", trips())


def hourly_demand_by_type(spark, sf_dir):
    return by_type(spark, sf_dir).select("event_type", "ts", "idx", trips())


def hourly_demand_by_user(spark, sf_dir):
    """Many keys, mostly empty hours."""
    return se.demand_series(tb.table(spark, sf_dir, "events"), keys=["user_id"]).select("user_id", "ts", "idx", trips())


def hourly_demand_common_range(spark, sf_dir):
    """All types over the range of the whole log."""
    events = tb.table(spark, sf_dir, "events")
    return se.demand_series(events, keys=["user_id"], common_range=True).select("user_id", "ts", "idx", trips())


def daily_orders(spark, sf_dir):
    orders = tb.table(spark, sf_dir, "orders")
    return se.demand_series(orders, "o_orderdate", bucket="day").select("ts", "idx", trips())


def daily_shipments(spark, sf_dir):
    items = tb.table(spark, sf_dir, "lineitem")
    return se.demand_series(items, "l_shipdate", keys=["l_returnflag"], bucket="day").select("l_returnflag", "ts", "idx", trips())


def hourly_demand_bounded(spark, sf_dir):
    """One week; the bounds reach the scan."""
    events = tb.table(spark, sf_dir, "events")
    return se.demand_series(events, keys=KEY, start="2024-01-08", end="2024-01-15").select("event_type", "ts", "idx", trips())


def text_log_bounded(spark, sf_dir):
    """Times as text, a tenth of them unreadable, within bounds."""
    events = tb.table(spark, sf_dir, "events")
    text = F.when(F.col("event_id") % 10 == 0, F.lit("n/a")).otherwise(F.col("ts").cast("string"))
    return se.demand_series(events.withColumn("ts", text), keys=KEY, start="2024-01-08", end="2024-01-15").select("event_type", "ts", "idx", trips())


def series_extent(spark, sf_dir):
    return se.series_extent(by_type(spark, sf_dir), KEY)


def head_preview(spark, sf_dir):
    return wi.head_rows(overall(spark, sf_dir)).select("ts", trips())


def sample_hash(spark, sf_dir):
    return se.sample_by_hash(tb.table(spark, sf_dir, "events"), "event_id", 0.1).select("event_id")


def sample_exact(spark, sf_dir):
    return se.sample_exact(tb.table(spark, sf_dir, "events").select("event_id"), "event_id", 0.1)


# --- sources and sinks -------------------------------------------------------------


def union_slices(spark, sf_dir):
    """Two halves of the orders, the second without the price column, as one table."""
    orders = tb.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    early = se.between(orders, "o_orderdate", end="1998-01-01")
    late = se.between(orders, "o_orderdate", start="1998-01-01").drop("o_totalprice")
    both = tb.union_months([early, late]).select("*", *tb.months_of("o_orderdate"))
    return both.groupBy("year", "month").agg(F.count("*").alias("n"), F.count("o_totalprice").alias("n_price"))


def ingest_missing_months(spark, sf_dir):
    """A target that holds the months before 1998 takes in the rest of the orders."""
    orders = tb.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    target = scratch_dir(spark, "ingest")
    tb.write_months(se.between(orders, "o_orderdate", end="1998-01-01").withColumn("run", F.lit(1)), target, "o_orderdate")
    tb.ingest_months(orders.withColumn("run", F.lit(2)), target, "o_orderdate")
    return spark.read.parquet(target).groupBy("year", "month", "run").agg(F.count("*").alias("n"))


def ingest_after_failure(spark, sf_dir):
    """A run that ended while months were half written: the next one writes these again and leaves whole ones."""
    orders = tb.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    target = scratch_dir(spark, "ingest")
    tb.write_months(se.between(orders, "o_orderdate", end="1998-01-01").withColumn("run", F.lit(1)), target, "o_orderdate")
    late = se.between(orders, "o_orderdate", start="1998-01-01").withColumn("run", F.lit(2)).select("*", *tb.months_of("o_orderdate"))
    late.where(F.dayofmonth("o_orderdate") <= 15).write.mode("append").partitionBy("year", "month").parquet(target)
    tb.ingest_months(orders.withColumn("run", F.lit(3)), target, "o_orderdate")
    schema = late.select("o_orderkey", "o_orderdate", "run", "year", "month").schema
    return tb.read_complete_months(spark, target, schema).groupBy("year", "month", "run").agg(F.count("*").alias("n"))


def scan_monthly_files(spark, sf_dir):
    """Orders as month files, read back for a list of months that goes beyond them."""
    orders = tb.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    target = scratch_dir(spark, "months")
    named = orders.withColumn("month_file", F.date_format("o_orderdate", "yyyy-MM"))
    named.write.partitionBy("month_file").parquet(target)
    template = target + "/month_file={year}-{month:02d}"
    found = tb.read_months(spark, template, tb.month_range((1990, 1), (2005, 12)), orders.schema)
    return found.groupBy(*tb.months_of("o_orderdate")).agg(F.count("*").alias("n"))


def csv_roundtrip(spark, sf_dir):
    """Events to CSV and back, then hourly counts."""
    events = tb.table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    path = scratch_dir(spark, "events-csv")
    tb.write_csv(events, path)
    return se.demand_series(tb.read_events_csv(spark, path, events.schema), keys=KEY).select("event_type", "ts", "idx", trips())


def series_csv_roundtrip(spark, sf_dir):
    """The hourly series as CSV and back, in the layout of the series file."""
    path = scratch_dir(spark, "series-csv")
    tb.write_csv(overall(spark, sf_dir).select(F.col("ts").alias("timestamp"), trips()), path)
    return tb.read_series_csv(spark, path).select(F.col("timestamp").alias("ts"), "trip_count")


def processed_roundtrip(spark, sf_dir):
    """Features with both parts written as one table, the parts read back and counted by hour of day."""
    path = scratch_dir(spark, "processed")
    table = ft.calendar_features(ft.with_split(by_type(spark, sf_dir)))
    tb.write_processed(table, path)
    back = spark.read.schema(table.schema).parquet(path)
    return back.groupBy("event_type", "split", "hour").agg(F.count("*").alias("n"), F.sum("y").alias("total"), F.max("ts").alias("last"))


def floored_events(spark, sf_dir):
    """Events per opening time of their minute and type."""
    events = tb.table(spark, sf_dir, "events")
    return events.groupBy("event_type", floor_to_bucket(F.col("ts"), "minute").alias("minute")).agg(F.count("*").alias("n"))


def regression_frames(spark, sf_dir):
    """The training frame without missing values and the future frame, in the naming of regression libraries."""
    table = ft.with_cut(by_type(spark, sf_dir)).withColumn("y", F.when(F.col("idx") % 7 != 0, F.col("y")))
    train = ft.regression_frame(ft.drop_missing(ft.train_rows(table)), KEY)
    future = ft.future_frame(ft.test_rows(table), KEY)
    return train.withColumn("part", F.lit("train")).unionByName(future.withColumn("part", F.lit("future")), allowMissingColumns=True)


# --- features and splits -----------------------------------------------------------


def time_features(spark, sf_dir):
    waves = ["hour_sin", "hour_cos", "day_sin", "day_cos"]
    plain = ["ts", "hour", "day_of_week", "day_of_month", "month", "is_weekend"]
    return ft.calendar_features(overall(spark, sf_dir)).select(*plain, *[r6(w) for w in waves])


def normalize(spark, sf_dir):
    s = overall(spark, sf_dir)
    return ft.normalize(s, ft.norm_params(s), name="trip_count_normalized").select("ts", trips(), r6("trip_count_normalized"))


def norm_params(spark, sf_dir):
    return ft.norm_params(by_type(spark, sf_dir), KEY).select("event_type", r6("mean"), r6("std"))


def norm_params_train(spark, sf_dir):
    """Parameters from the training part only: no look at the test rows."""
    return ft.norm_params(by_type(spark, sf_dir), KEY, fit_on="train").select("event_type", r6("mean"), r6("std"))


def norm_params_roundtrip(spark, sf_dir):
    """Parameters of many keys as JSON and back, keys as whole numbers."""
    s = se.demand_series(tb.table(spark, sf_dir, "events"), keys=["user_id"])
    path = scratch_dir(spark, "norm-params")
    tb.write_norm_params(ft.norm_params(s, ["user_id"]), path)
    return tb.read_norm_params(spark, path, s.select("user_id").schema).select("user_id", r6("mean"), r6("std"))


def adf_by_user(spark, sf_dir):
    """Many series, some too short or flat for a test: those give the reason."""
    found = adf_test(se.demand_series(tb.table(spark, sf_dir, "events"), keys=["user_id"]), ["user_id"])
    return found.select("user_id", r6("tau"), r6("pvalue"), "usedlag", "nobs", "is_stationary", "reason")


def denormalize_roundtrip(spark, sf_dir):
    s = by_type(spark, sf_dir)
    params = ft.norm_params(s, KEY)
    back = ft.denormalize(ft.normalize(s, params, KEY), params, KEY)
    return back.select("event_type", "ts", "y", r6("y_back"))


def train_test_split(spark, sf_dir):
    return se.series_extent(ft.with_split(by_type(spark, sf_dir)), KEY, ["split"])


# --- windows -----------------------------------------------------------------------


def moving_average_24(spark, sf_dir):
    return wi.trailing_mean(by_type(spark, sf_dir), KEY).select("event_type", "ts", "y", r6("pred"))


def lag_windows(spark, sf_dir):
    x = wi.supervised_windows(ft.with_split(overall(spark, sf_dir)))
    total = F.aggregate("x", F.lit(0.0), lambda a, v: a + v)
    return x.select(
        "split", "ts", "y", F.size("x").alias("n_x"), F.col("x")[0].alias("x_first"), F.col("x")[23].alias("x_last"), total.alias("x_sum")
    )


def recon_windows(spark, sf_dir):
    x = wi.reconstruction_windows(overall(spark, sf_dir))
    total = F.aggregate("x", F.lit(0.0), lambda a, v: a + v)
    return x.select("ts", F.col("x")[0].alias("x_first"), F.col("x")[23].alias("x_last"), r6("x_mean", total / 24))


def decompose_hourly(spark, sf_dir):
    # Many of these are whole 128ths, half way between two values of six places.
    d = decompose(by_type(spark, sf_dir), KEY)
    return d.select("event_type", "ts", "observed", *[r6(c, places=8) for c in ("trend", "seasonal", "resid")])


def decompose_yearly(spark, sf_dir):
    """A period longer than a block: 8,760 rows, of minutes for want of a year of hours."""
    minutes = kept(se.demand_series(tb.table(spark, sf_dir, "events"), bucket="minute"))
    return decompose(minutes, period=8760).select("ts", "observed", *[r6(c, places=8) for c in ("trend", "seasonal", "resid")])


def moving_average_long(spark, sf_dir):
    """Minutes per type against the mean of the six days before."""
    minutes = kept(se.demand_series(tb.table(spark, sf_dir, "events"), keys=KEY, bucket="minute"))
    return wi.trailing_mean(minutes, KEY, 8640).select("event_type", "ts", "y", r6("pred"))


# --- validation and evaluation -----------------------------------------------------


def walk_forward_folds(spark, sf_dir):
    return folds.fold_table(by_type(spark, sf_dir), KEY)


def _ma(series, keys):
    return wi.trailing_mean(series, keys)


def walk_forward_rmse(spark, sf_dir):
    """Each fold is its own copy of the series, and the model is a callback."""
    return folds.walk_forward(by_type(spark, sf_dir), _ma, KEY).select("event_type", "fold", r6("rmse"))


def walk_forward_callback(spark, sf_dir):
    """A model given by its own code, fitted block by block and merged."""
    return folds.walk_forward(kept(by_type(spark, sf_dir)), folds.block_forecaster(folds.PhaseMeans(24)), KEY).select("event_type", "fold", r6("rmse"))


def walk_forward_summary(spark, sf_dir):
    """The moving average looks only at earlier rows, so it runs once for all folds."""
    per_fold = folds.walk_forward(by_type(spark, sf_dir), _ma, KEY, refit=False)
    return folds.summarize_folds(per_fold, KEY).select("event_type", r6("mean_rmse"), r6("std_rmse"))


def _two_models(series: DataFrame) -> DataFrame:
    """Moving average and yesterday's value on the test rows, both from one window."""

    def build(w):
        return {"pred_moving_average": F.avg("y").over(w.rowsBetween(-24, -1)), "pred_same_hour_yesterday": F.lag("y", 24).over(w)}

    test = ft.test_rows(ft.with_cut(wi.over_time(series, KEY, build, before=24)))
    return test.withColumnRenamed("y", "actual")


MODELS = ["moving_average", "same_hour_yesterday"]


def _predictions(spark, sf_dir) -> DataFrame:
    # A third name is asked for and passed over: no such column exists.
    return ev.melt_predictions(_two_models(by_type(spark, sf_dir)), [*MODELS, "arima"], KEY)


def _metric_columns() -> list[Column]:
    return [r6(m) for m in ("MAE", "RMSE", "MAPE", "SMAPE", "R2")]


def forecast_metrics(spark, sf_dir):
    return ev.evaluate(_predictions(spark, sf_dir), KEY).select("event_type", "model", *_metric_columns())


def metrics_with_gaps(spark, sf_dir):
    """Every fifth prediction missing: those rows count in no measure."""
    gappy = _predictions(spark, sf_dir).withColumn("pred", F.when(F.col("idx") % 5 != 0, F.col("pred")))
    return ev.rank_by_rmse(ev.evaluate(gappy, KEY), KEY).select("event_type", "model", *_metric_columns(), "rank")


def forecast_metrics_head_aligned(spark, sf_dir):
    """The window mean starts 24 rows into the test part and is still paired from its head."""
    s = ft.with_split(by_type(spark, sf_dir))
    x = wi.supervised_windows(s, KEY).where(F.col("split") == "test")
    mean = F.aggregate("x", F.lit(0.0), lambda a, v: a + v) / 24
    preds = x.select("event_type", F.lit("window_mean").alias("model"), "idx", mean.alias("pred"))
    return ev.evaluate(ev.align_heads(preds, s, KEY), KEY).select("event_type", "model", *_metric_columns())


def model_ranking(spark, sf_dir):
    metrics = ev.evaluate(_predictions(spark, sf_dir), KEY).select("event_type", "model", *_metric_columns())
    return ev.rank_models(metrics, KEY)


def metrics_report(spark, sf_dir):
    """The metrics written as a report, read back, with the names and lines as printed."""
    path = scratch_dir(spark, "metrics")
    metrics = ev.evaluate(_predictions(spark, sf_dir), KEY).select("event_type", "model", *_metric_columns())
    tb.write_metrics(metrics, path)
    back = tb.read_events_csv(spark, path, metrics.schema)
    shown = labels.title(F.col("model"))
    return back.select(
        "event_type",
        "model",
        shown.alias("title"),
        labels.file_name(shown).alias("file_name"),
        labels.last_part(F.col("model")).alias("last_part"),
        labels.metric_line(shown, F.round("MAE", 2), F.round("RMSE", 2)).alias("line"),
    )


def predictions_long(spark, sf_dir):
    return _predictions(spark, sf_dir).select("event_type", "model", "ts", "actual", r6("pred"))


def predictions_wide(spark, sf_dir):
    wide = ev.forecast_chart(_predictions(spark, sf_dir), MODELS, KEY)
    return wide.select("event_type", "ts", "actual", *[r6(f"pred_{m}") for m in MODELS])


# --- anomalies ---------------------------------------------------------------------


def _profile(spark, sf_dir) -> DataFrame:
    return scores.profile_scores(by_type(spark, sf_dir), KEY)


def profile_recon_scores(spark, sf_dir):
    return _profile(spark, sf_dir).select("event_type", "ts", r6("score"))


def _flagged_profile(spark, sf_dir) -> DataFrame:
    """A threshold reads the scores more than once, so they are written first."""
    return scores.flag_scores(kept(_profile(spark, sf_dir)), KEY)


def profile_recon_flags(spark, sf_dir):
    flagged = _flagged_profile(spark, sf_dir)
    return flagged.select("event_type", "ts", r6("score"), r6("threshold"), "is_anomaly")


def anomaly_points(spark, sf_dir):
    hits = scores.anomaly_points(_flagged_profile(spark, sf_dir))
    return hits.select("event_type", "ts", "y", r6("score"))


def anomaly_summary(spark, sf_dir):
    summary = scores.anomaly_summary(_flagged_profile(spark, sf_dir), KEY)
    return summary.select("event_type", "n", "n_anom", r6("pct"))


def _two_methods(spark, sf_dir) -> DataFrame:
    """Profile scores and the mean distance of each window from the moving average."""
    s = overall(spark, sf_dir)
    ma = wi.trailing_mean(s)
    errors = ma.withColumn("err", F.coalesce(F.abs(F.col("y") - F.col("pred")), F.lit(0.0)))
    return scores.profile_scores(s).unionByName(scores.window_mean_error(errors, "moving_average"))


def anomaly_wide(spark, sf_dir):
    wide = scores.widen_scores(_two_methods(spark, sf_dir), ["profile", "moving_average"])
    return wide.select("ts", F.col("trip_count").cast("bigint").alias("trip_count"), r6("anomaly_score_profile"), r6("anomaly_score_moving_average"))


def anomaly_wide_rescaled(spark, sf_dir):
    """Counts of a sample have fractions once they stand for the whole log."""
    scored = _two_methods(spark, sf_dir)
    wide = scores.widen_scores(se.rescale_sampled(scored, 0.3), ["profile", "moving_average"])
    return wide.select("ts", r6("trip_count"), r6("anomaly_score_profile"), r6("anomaly_score_moving_average"))


def display_threshold_flags(spark, sf_dir):
    # 500 rows, fewer than a series has, so that the slice matters.
    return scores.display_flags(kept(_profile(spark, sf_dir)), KEY, rows=500).select("event_type", "ts", r6("score"), r6("threshold"), "flag")


def score_chart(spark, sf_dir):
    return scores.score_chart(kept(_two_methods(spark, sf_dir)), rows=500).select("method", "ts", r6("score"), r6("p95"))


# --- exploration -------------------------------------------------------------------


def hist50(spark, sf_dir):
    return explore.histogram(by_type(spark, sf_dir), KEY).select("event_type", "bin", r6("lo"), r6("hi"), "n")


def kde(spark, sf_dir):
    return explore.density(by_type(spark, sf_dir), KEY).select("event_type", "point", r6("x"), r6("density"))


def box_by_weekday(spark, sf_dir):
    return explore.box_by_weekday(overall(spark, sf_dir))


def box_by_hour(spark, sf_dir):
    return explore.box_by_hour(overall(spark, sf_dir))


def _event_values(spark, sf_dir) -> DataFrame:
    return tb.table(spark, sf_dir, "events").select("event_type", "value")


def box_value(spark, sf_dir):
    """Quartiles and whiskers of a continuous column."""
    return explore.box_statistics(_event_values(spark, sf_dir), {"event_type": F.col("event_type")}, value="value")


def kde_value(spark, sf_dir):
    """Density of a continuous column."""
    return explore.density(_event_values(spark, sf_dir), KEY, value="value").select("event_type", "point", r6("x"), r6("density"))


def percentiles_value(spark, sf_dir):
    """Several exact percentiles of a continuous column at once; few values are put in order at a time."""
    wanted = {f"p{p}": p / 100 for p in (1, 25, 50, 75, 95, 99)}
    return exact_percentiles(_event_values(spark, sf_dir), KEY, "value", wanted, small=50).select("event_type", *[r6(p) for p in wanted])


# --- stationarity ------------------------------------------------------------------


def df_lag0(spark, sf_dir):
    return dickey_fuller(by_type(spark, sf_dir), KEY).select("event_type", r6("tau"))


def adf(spark, sf_dir):
    names = ("tau", "pvalue", "cv1", "cv5", "cv10")
    return adf_test(by_type(spark, sf_dir), KEY).select("event_type", *[r6(c) for c in names], "usedlag", "nobs", "is_stationary")


# --- forecasts ---------------------------------------------------------------------


def _cut(spark, sf_dir) -> DataFrame:
    return ft.with_cut(by_type(spark, sf_dir))


def holt_winters_fixed(spark, sf_dir):
    """One-step predictions over the whole series with given weights."""
    whole = by_type(spark, sf_dir).withColumn("cut", F.col("n"))
    return smoothed(whole, KEY, (0.3, 0.05, 0.1)).select("event_type", "idx", "y", r6("pred"))


def holt_winters_grid(spark, sf_dir):
    """Best weights of the grid on the training part, forecast of the test part."""
    return holt_winters(_cut(spark, sf_dir), KEY).select("event_type", "ts", r6("pred"), "alpha", "beta", "gamma", r6("sse"))


def fourier_trend_forecast(spark, sf_dir):
    return trend_forecast(_cut(spark, sf_dir), KEY).select("event_type", "ts", "y", r6("pred"))


def fourier_trend_tuned(spark, sf_dir):
    """The penalty of the bends chosen within the training part."""
    out = trend_forecast(_cut(spark, sf_dir), KEY, penalty=None)
    return out.select("event_type", "ts", "y", r6("pred"), "penalty", r6("mean_rmse"))


def _logged(table: DataFrame) -> DataFrame:
    return table.withColumn("log_count", F.log1p("y"))


def fourier_trend_target(spark, sf_dir):
    """A forecast of another column than the count."""
    return trend_forecast(_logged(_cut(spark, sf_dir)), KEY, value="log_count").select("event_type", "ts", r6("y"), r6("pred"))


def profile_recon_target(spark, sf_dir):
    """A detector on another column than the count."""
    flagged = scores.flag_scores(kept(scores.profile_scores(_logged(by_type(spark, sf_dir)), KEY, value="log_count")), KEY)
    return flagged.select("event_type", "ts", r6("score"), r6("threshold"), "is_anomaly")


def sarima_css(spark, sf_dir):
    return sarima(ft.with_cut(kept(by_type(spark, sf_dir))), KEY).select("event_type", "ts", "y", r6("pred"), r6("aic"), r6("bic"))


def sarima_orders(spark, sf_dir):
    """Two stated orders; the seasonal one searched over blocks of ten days."""
    table = ft.with_cut(kept(overall(spark, sf_dir)))
    plain = sarima(table, order=(1, 0, 1)).withColumn("model", F.lit("(1,0,1)"))
    seasonal = sarima(table, block=240, order=(0, 1, 1), seasonal_order=(0, 1, 1, 24)).withColumn("model", F.lit("(0,1,1)(0,1,1,24)"))
    return plain.unionByName(seasonal).select("model", "ts", "y", r6("pred"), r6("aic"), r6("bic"))


def _lag_regression(name):
    def query(spark, sf_dir):
        out = lm.lag_forecast(kept(by_type(spark, sf_dir)), name, KEY)
        return out.select("event_type", "ts", F.col("y").alias("actual"), r6("pred"))

    query.__name__ = f"lag_regression_{name}"
    return query


lag_regression_lr, lag_regression_rf, lag_regression_gbt = map(_lag_regression, ("lr", "rf", "gbt"))


def training_history(spark, sf_dir):
    """Loss on both splits after every epoch."""
    return descent.loss_history(descent.fit_epochs(kept(by_type(spark, sf_dir)), KEY)).select("model", "split", "iteration", r6("loss"))


def learner_history(spark, sf_dir):
    """Objective per step of the linear learner, error per tree of the boosted one."""
    return lm.training_history(kept(by_type(spark, sf_dir)), KEY).select("model", "split", "iteration", r6("loss"))


def model_artifact(spark, sf_dir):
    """Losses and weights of the epochs written as a model, read back, and used for a forecast."""
    series, path = kept(by_type(spark, sf_dir)), scratch_dir(spark, "model")
    descent.save_epochs(descent.fit_epochs(series, KEY), path)
    out = descent.epoch_forecast(series, descent.load_epochs(spark, path), KEY)
    return out.select("event_type", "ts", F.col("y").alias("actual"), r6("pred"))


def compare_forecasts(spark, sf_dir):
    """All forecasters on the test rows they share, with their metrics and their ranks among forecasts of their kind."""
    shared = ev.on_common_rows(forecast_all(kept(by_type(spark, sf_dir)), KEY), KEY)
    by = [*KEY, "forecast"]
    return ev.rank_by_rmse(ev.evaluate(kept(shared), by), by).select(*by, "model", *_metric_columns(), "rank")


def compare_models(spark, sf_dir):
    """The forecasters that SQL can state, every key with a row for each of them."""
    models = ("sarima", "exp_smoothing", "trend_waves", "moving_average", "lag_linear")
    found = ev.compare_models(kept(forecast_all(kept(by_type(spark, sf_dir)), KEY, models)), KEY)
    return found.select(*KEY, "forecast", "model", *[r6(m, places=4) for m in ("MAE", "RMSE", "MAPE", "SMAPE", "R2")], "rank", "reason")


# --- detectors ---------------------------------------------------------------------


def _flagged(scored: DataFrame, keys=()) -> DataFrame:
    return scores.flag_scores(kept(scored), keys).select(*keys, "ts", "y", r6("score"), r6("threshold"), "is_anomaly")


def isolation_forest(spark, sf_dir):
    return _flagged(score_by_forest(kept(overall(spark, sf_dir))))


def isolation_forest_by_user(spark, sf_dir):
    """Many series in one forest."""
    return _flagged(score_by_forest(kept(se.demand_series(tb.table(spark, sf_dir, "events"), keys=["user_id"])), ["user_id"]), ["user_id"])


def pca_recon(spark, sf_dir):
    return _flagged(pattern_scores(kept(by_type(spark, sf_dir)), KEY), KEY)


def sequence_residual(spark, sf_dir):
    return _flagged(lm.sequence_scores(kept(by_type(spark, sf_dir)), KEY), KEY)


# --- streaming ---------------------------------------------------------------------


def hourly_demand_stream(spark, sf_dir):
    """The event log as a stream: hours the watermark has closed."""
    schema = tb.table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    out = run_once(closed_hours(stream, keys=KEY), scratch_dir(spark, "stream"))
    return out.select("event_type", "ts", "trip_count")


def stream_gap_filled(spark, sf_dir):
    """Every hour of each type up to the watermark, empty ones included, with the mean of the 24 hours before."""
    schema = tb.table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    out = run_gapless(stream, scratch_dir(spark, "gapless"), keys=KEY)
    return out.select("event_type", "ts", "y", r6("pred"))


QUERIES = {
    f.__name__: f
    for f in (
        hourly_demand,
        hourly_demand_by_type,
        hourly_demand_by_user,
        hourly_demand_common_range,
        daily_orders,
        daily_shipments,
        hourly_demand_bounded,
        text_log_bounded,
        series_extent,
        head_preview,
        sample_hash,
        sample_exact,
        union_slices,
        ingest_missing_months,
        ingest_after_failure,
        scan_monthly_files,
        csv_roundtrip,
        series_csv_roundtrip,
        processed_roundtrip,
        floored_events,
        regression_frames,
        time_features,
        normalize,
        norm_params,
        norm_params_train,
        norm_params_roundtrip,
        denormalize_roundtrip,
        train_test_split,
        moving_average_24,
        lag_windows,
        recon_windows,
        decompose_hourly,
        decompose_yearly,
        moving_average_long,
        walk_forward_folds,
        walk_forward_rmse,
        walk_forward_summary,
        walk_forward_callback,
        forecast_metrics,
        metrics_with_gaps,
        forecast_metrics_head_aligned,
        model_ranking,
        metrics_report,
        predictions_long,
        predictions_wide,
        profile_recon_scores,
        profile_recon_flags,
        anomaly_points,
        anomaly_summary,
        anomaly_wide,
        anomaly_wide_rescaled,
        display_threshold_flags,
        score_chart,
        hist50,
        kde,
        box_by_weekday,
        box_by_hour,
        box_value,
        kde_value,
        percentiles_value,
        df_lag0,
        adf,
        adf_by_user,
        holt_winters_fixed,
        holt_winters_grid,
        fourier_trend_forecast,
        fourier_trend_tuned,
        fourier_trend_target,
        profile_recon_target,
        sarima_css,
        sarima_orders,
        lag_regression_lr,
        lag_regression_rf,
        lag_regression_gbt,
        training_history,
        learner_history,
        model_artifact,
        compare_forecasts,
        compare_models,
        isolation_forest,
        isolation_forest_by_user,
        pca_recon,
        sequence_residual,
        hourly_demand_stream,
        stream_gap_filled,
    )
}
