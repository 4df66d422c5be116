"""All forecasters side by side on one series table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from demandtide.operators.evaluate import as_predictions, gather_predictions
from demandtide.operators.features import test_rows, with_cut
from demandtide.operators.lagmodels import lag_forecast
from demandtide.operators.sarima import sarima
from demandtide.operators.smoothing import holt_winters
from demandtide.operators.trend import trend_forecast
from demandtide.operators.windows import trailing_mean

# Blind forecasts of the whole test part, fitted per series.
AHEAD: dict[str, Callable[[DataFrame, Sequence[str]], DataFrame]] = {
    "sarima": lambda table, keys: sarima(table, keys),
    "exp_smoothing": lambda table, keys: holt_winters(table, keys),
    "trend_waves": lambda table, keys: trend_forecast(table, keys),
}

# One step ahead with all earlier actuals known.
ONE_STEP: dict[str, Callable[[DataFrame, Sequence[str]], DataFrame]] = {
    "moving_average": lambda table, keys: test_rows(trailing_mean(table, keys)),
    "lag_linear": lambda table, keys: lag_forecast(table, "lr", keys),
    "lag_forest": lambda table, keys: lag_forecast(table, "rf", keys),
    "lag_boosting": lambda table, keys: lag_forecast(table, "gbt", keys),
}

MODELS = (*AHEAD, *ONE_STEP)


def forecast_all(series: DataFrame, keys: Sequence[str] = (), models: Sequence[str] = MODELS, test_size: float = 0.2) -> DataFrame:
    """Long predictions of the named models. Write ``series`` first: every model reads it."""
    table = with_cut(series, test_size)
    parts = [as_predictions(AHEAD[m](table, keys), m, keys) for m in models if m in AHEAD]
    parts += [as_predictions(ONE_STEP[m](table, keys), m, keys, one_step=True) for m in models if m in ONE_STEP]
    return gather_predictions(parts)
