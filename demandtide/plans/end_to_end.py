"""From event log to forecasts, anomaly scores and reports, as tables in one folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandtide.operators import evaluate as ev
from demandtide.operators import features as ft
from demandtide.operators import scores as sc
from demandtide.operators.decompose import decompose
from demandtide.operators.isolation import isolation_forest
from demandtide.operators.lagmodels import sequence_scores
from demandtide.operators.reconstruction import pattern_scores
from demandtide.operators.series import demand_series, rescale_sampled, sample_by_hash
from demandtide.operators.stationarity import adf_test
from demandtide.plans.models import MODELS, forecast_all
from demandtide.sources import tables as tb

DETECTORS = {"isolation_forest": isolation_forest, "patterns": pattern_scores, "sequence": sequence_scores}


def prepare(series: DataFrame, out: str, keys: Sequence[str] = (), test_size: float = 0.2) -> None:
    """Feature table by split, normalization parameters, unit-root test, decomposition."""
    params = ft.norm_params(series, keys)
    features = ft.with_split(ft.calendar_features(ft.normalize(series, params, keys, name="trip_count_normalized")), test_size)
    tb.write_processed(features, f"{out}/features")
    tb.write_norm_params(params, f"{out}/norm_params")
    adf_test(series, keys).write.mode("overwrite").parquet(f"{out}/stationarity")
    decompose(series, keys).write.mode("overwrite").parquet(f"{out}/decomposition")


def forecast(series: DataFrame, out: str, keys: Sequence[str] = (), models: Sequence[str] = MODELS) -> DataFrame:
    """Predictions of all models, their metrics and rankings."""
    predictions = tb.write_and_read(forecast_all(series, keys, models), f"{out}/predictions")
    ev.forecast_chart(predictions, models, keys).write.mode("overwrite").parquet(f"{out}/forecast_chart")
    metrics = tb.write_and_read(ev.evaluate(predictions, keys), f"{out}/metrics")
    tb.write_metrics(metrics, f"{out}/metrics_csv")
    ev.rank_models(metrics, keys).write.mode("overwrite").parquet(f"{out}/ranking")
    return metrics


def detect(series: DataFrame, out: str, keys: Sequence[str] = (), detectors: Sequence[str] = tuple(DETECTORS)) -> DataFrame:
    """Scores of all detectors, flags, chart table."""
    every = ev.gather_predictions([DETECTORS[d](series, keys) for d in detectors])
    scores = tb.write_and_read(every, f"{out}/scores")
    sc.widen_scores(scores, detectors, keys).write.mode("overwrite").parquet(f"{out}/scores_wide")
    flagged = tb.write_and_read(sc.flag_scores(scores, keys), f"{out}/flags")
    sc.score_chart(scores, keys).write.mode("overwrite").parquet(f"{out}/score_chart")
    return sc.anomaly_summary(flagged, keys)


def run(
    events: DataFrame,
    out: str,
    ts_col: str = "ts",
    keys: Sequence[str] = (),
    sample: tuple[str, float] | None = None,
    rescale: bool = False,
    start: str | None = None,
    end: str | None = None,
) -> dict[str, DataFrame]:
    """The whole way. The log is read once; everything later reads the written series.

    ``sample`` is (id column, fraction); counts of a sample stay small unless ``rescale``.
    """
    if sample is not None:
        events = sample_by_hash(events, *sample)
    counted = demand_series(events, ts_col, keys, start=start, end=end)
    if sample is not None and rescale:
        counted = rescale_sampled(counted, sample[1])
    series = tb.write_and_read(counted, f"{out}/series")
    prepare(series, out, keys)
    return {"metrics": forecast(series, out, keys), "anomalies": detect(series, out, keys).orderBy(*keys, F.col("method"))}
