"""Prediction tables, error measures, model rankings.

Predictions are long: ``keys, model, ts, idx, n, actual, pred``. Any model name will do;
a model that made no predictions has no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandtide.functions.metrics import HIGHER_IS_BETTER, all_metrics
from demandtide.operators.windows import last_rows

#: The two kinds of forecast.
ONE_STEP, AHEAD = "one step", "ahead"


def as_predictions(rows: DataFrame, model: str, keys: Sequence[str] = (), one_step: bool = False) -> DataFrame:
    """Forecast rows (``ts, idx, n, cut, y, pred``) in the long layout, with their ``horizon``.

    The horizon is 1 for a model that sees all earlier actuals, else the distance from the
    last training row. Metrics of the two kinds do not compare; ``forecast`` names the kind.
    """
    horizon = F.lit(1).cast("bigint") if one_step else F.col("idx") - F.col("cut") + 1
    return rows.select(
        *keys, F.lit(model).alias("model"), "ts", "idx", "n", F.col("y").alias("actual"), "pred", horizon.alias("horizon"), F.lit(ONE_STEP if one_step else AHEAD).alias("forecast")
    )


def melt_predictions(wide: DataFrame, models: Sequence[str], keys: Sequence[str] = (), prefix: str = "pred_") -> DataFrame:
    """Columns ``pred_<model>`` to rows. Models without a column are passed over."""
    ids = [*keys, *[c for c in ("ts", "idx", "n", "actual") if c in wide.columns]]
    there = [m for m in models if prefix + m in wide.columns]
    named = wide.select(*ids, *[F.col(prefix + m).cast("double").alias(m) for m in there])
    return named.unpivot(ids, there, "model", "pred").where(F.col("pred").isNotNull())


def gather_predictions(tables: Sequence[DataFrame]) -> DataFrame:
    """Several long tables as one; columns are matched by name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def widen_predictions(predictions: DataFrame, models: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """``ts, actual, pred_<model> ...``"""
    wide = predictions.groupBy(*keys, "ts", "actual").pivot("model", list(models)).agg(F.first("pred"))
    return wide.select(*keys, "ts", "actual", *[F.col(m).alias(f"pred_{m}") for m in models])


def forecast_chart(predictions: DataFrame, models: Sequence[str], keys: Sequence[str] = (), rows: int = 500) -> DataFrame:
    """The last rows, all models side by side."""
    return widen_predictions(last_rows(predictions, rows), models, keys)


def evaluate(predictions: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row of metrics per key and model; rows are paired by timestamp."""
    return predictions.groupBy(*keys, "model").agg(*all_metrics(F.col("actual"), F.col("pred")))


def _with_kind(predictions: DataFrame) -> DataFrame:
    """The kind of forecast as column ``forecast``. Tables without it tell by the model's horizons over all keys."""
    if "forecast" in predictions.columns:
        return predictions
    kinds = predictions.groupBy("model").agg(F.when(F.max("horizon") > 1, AHEAD).otherwise(ONE_STEP).alias("forecast"))
    return predictions.join(kinds, "model").select(*predictions.columns, "forecast")


def on_common_rows(predictions: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Predictions of the rows that every model with a forecast for the key predicts, by kind of forecast.

    The kinds, ``one step`` and ``ahead``, come as column ``forecast``: their errors do not compare,
    and a model that starts later would otherwise be judged on easier or harder rows. A kind belongs
    to a model, not to a key; a model without any forecast for a key does not take part there.
    """
    by = [*keys, "forecast"]
    rows = _with_kind(predictions).where(F.col("pred").isNotNull())
    models = rows.groupBy(*by).agg(F.count_distinct("model").alias("models"))
    rest = [c for c in rows.columns if c not in (*by, "ts")]
    each = rows.groupBy(*by, "ts").agg(F.collect_list(F.struct(*rest)).alias("each"))
    shared = each.join(models, by).where(F.array_size(F.array_distinct(F.col("each.model"))) == F.col("models"))
    out = shared.select(*by, "ts", F.inline("each"))
    return out.select(*[c for c in predictions.columns if c != "forecast"], "forecast")


def compare_models(predictions: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``keys, forecast, model``, the metrics on common rows, ``rank`` by RMSE and ``reason``.

    Every key has a row for every model of the table. Where there are no metrics, ``reason`` says
    whether the model has no forecast for the key or shares no row with the others. Write
    ``predictions`` first: it is read several times.
    """
    by = [*keys, "forecast", "model"]
    named = _with_kind(predictions)
    metrics = rank_by_rmse(evaluate(on_common_rows(named, keys), [*keys, "forecast"]), [*keys, "forecast"])
    # As many as there are models: one small array for all keys.
    models = named.groupBy().agg(F.collect_set(F.struct("forecast", "model")).alias("m")).scalar()
    seen = named.groupBy(*by).agg(F.count("pred").alias("_rows"))
    every = named.select(*(keys or [F.lit(0).alias("_all")])).distinct().select(*keys, F.explode(models).alias("m")).select(*keys, "m.*")
    joined = every.join(seen, by, "left").join(metrics, by, "left")
    reason = F.when(F.coalesce("_rows", F.lit(0)) == 0, "no forecast").when(F.col("RMSE").isNull(), "no common rows")
    return joined.withColumn("reason", reason).drop("_rows")


def align_heads(predictions: DataFrame, series: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Pair the i-th prediction of a model with the i-th test row, whatever their timestamps.

    Both lists end with the shorter one. ``series`` carries ``cut``. Positions come from
    ``idx``: predictions of a model have no gaps.
    """
    keys = list(keys)
    first = predictions.groupBy(*keys, "model").agg(F.min("idx").alias("first_idx"))
    moved = predictions.select(*keys, "model", "idx", "pred").join(first, [*keys, "model"])
    test = series.where(F.col("idx") >= F.col("cut")).select(*keys, "ts", "n", (F.col("idx") - F.col("cut")).alias("at"), "idx", F.col("y").alias("actual"))
    moved = moved.select(*keys, "model", (F.col("idx") - F.col("first_idx")).alias("at"), "pred")
    return moved.join(test, [*keys, "at"]).drop("at")


def rank_by_rmse(metrics: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return metrics.withColumn("rank", F.rank().over(Window.partitionBy(*keys).orderBy(F.col("RMSE").asc_nulls_last())))


def rank_models(metrics: DataFrame, keys: Sequence[str] = (), names: Sequence[str] = ("MAE", "RMSE", "MAPE", "R2")) -> DataFrame:
    """``metric, model, value, rank``; rank 1 is the best. A partition holds one row per model."""
    rows = metrics.unpivot([*keys, "model"], list(names), "metric", "value")
    badness = F.when(F.col("metric").isin(*HIGHER_IS_BETTER), -F.col("value")).otherwise(F.col("value"))
    order = Window.partitionBy(*keys, "metric").orderBy(badness.asc_nulls_last())
    return rows.select(*keys, "metric", "model", "value", F.rank().over(order).alias("rank"))
