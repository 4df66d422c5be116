"""One-step forecasts from the last 24 values by Spark ML regressors.

One model serves all series: values are normalized per key first and the forecasts are
turned back afterwards.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandtide.operators.features import denormalize, norm_params, normalize, with_split, with_target
from demandtide.operators.scores import window_mean_error
from demandtide.operators.windows import supervised_windows

SEED = 42

LEARNERS: dict[str, Callable] = {
    "lr": lambda **kw: LinearRegression(solver="normal", **kw),
    "lr_steps": lambda **kw: LinearRegression(solver="l-bfgs", maxIter=50, **kw),
    "rf": lambda **kw: RandomForestRegressor(numTrees=20, maxDepth=5, seed=SEED, **kw),
    "gbt": lambda **kw: GBTRegressor(maxIter=20, maxDepth=4, seed=SEED, **kw),
}


def learner(name: str):
    return LEARNERS[name](featuresCol="features", labelCol="z", predictionCol="z_pred")


def lag_frame(
    series: DataFrame, keys: Sequence[str] = (), length: int = 24, fit_on: str = "train", test_size: float = 0.2, across: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Windows as vectors with their label ``z``, and the normalization used.

    ``across`` lets windows reach from the training into the test part. A key whose training part is
    constant, such as an idle zone, has no spread to divide by: its windows hold zeros and its
    forecast is that constant.
    """
    params = norm_params(series, keys, fit_on, test_size).withColumn("std", F.coalesce("std", F.lit(0.0)))
    z = with_split(normalize(series, params, keys), test_size).where(F.col("y").isNotNull()).withColumn("z", F.coalesce("z", F.lit(0.0)))
    windows = supervised_windows(z, keys, length, "z", None if across else "split")
    return windows.withColumn("features", array_to_vector("x")).drop("x"), params


def lag_forecast(
    series: DataFrame, learner_name: str = "lr", keys: Sequence[str] = (), length: int = 24, fit_on: str = "train", test_size: float = 0.2, value: str = "y"
) -> DataFrame:
    """Train on the training windows, forecast the test windows: the rows with ``pred``.

    The first ``length`` test rows have no window of their own and no forecast.
    """
    series = with_target(series, value)
    frame, params = lag_frame(series, keys, length, fit_on, test_size)
    model = learner(learner_name).fit(frame.where(F.col("split") == "train").select("features", "z"))
    test = model.transform(frame.where(F.col("split") == "test"))
    return denormalize(test, params, keys, "z_pred", "pred").drop("features", "z", "z_pred")


def training_history(series: DataFrame, keys: Sequence[str] = (), length: int = 24, test_size: float = 0.2) -> DataFrame:
    """``model, split, iteration, loss``: mean squared error per boosting step, objective per descent step.

    A few dozen numbers that the finished models hold.
    """
    frame, _ = lag_frame(series, keys, length, test_size=test_size)
    spark = series.sparkSession
    parts = {name: frame.where(F.col("split") == name).select("features", "z") for name in ("train", "test")}
    steps = learner("lr_steps").fit(parts["train"]).summary.objectiveHistory
    trees = learner("gbt").fit(parts["train"])
    rows = [("lr_steps", "train", i, float(v)) for i, v in enumerate(steps)]
    for name, part in parts.items():
        rows += [("gbt", name, i, float(v)) for i, v in enumerate(boosting_losses(trees, part))]
    return spark.createDataFrame(rows, "model string, split string, iteration int, loss double")


def boosting_losses(model: GBTRegressionModel, part: DataFrame) -> list[float]:
    """Mean squared error after each boosting step, in one pass over ``part``."""
    return list(model.evaluateEachIteration(part, "squared"))


def sequence_scores(series: DataFrame, keys: Sequence[str] = (), length: int = 24, method: str = "sequence", value: str = "y") -> DataFrame:
    """Score table: mean squared one-step error of a linear lag model over each window.

    Trained on all rows, as a detector looks back. The first ``length`` rows have no
    one-step error; windows average those they have.
    """
    keys = list(keys)
    series = with_target(series, value)
    frame, params = lag_frame(series, keys, length, fit_on="all", across=True)
    model = learner("lr").fit(frame.select("features", "z"))
    err = (F.col("z") - F.col("z_pred")) * (F.col("z") - F.col("z_pred"))
    errors = model.transform(frame).select(*keys, "idx", err.alias("err"))
    every = series.select(*keys, "ts", "idx", "n", "y").join(errors, [*keys, "idx"], "left")
    return window_mean_error(every, method, keys, length).withColumn("score", F.coalesce("score", F.lit(0.0)))


def save_model(model: Model, path: str, history: DataFrame | None = None) -> None:
    """Model and, next to it, its loss history."""
    model.write().overwrite().save(path + "/model")
    if history is not None:
        history.write.mode("overwrite").parquet(path + "/history")

