"""Walk-forward validation: every fold of every series in one job."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandtide.functions.metrics import rmse
from demandtide.operators.attach import attach
from demandtide.operators.features import test_rows, train_rows
from demandtide.operators.numeric import DOUBLES, key_fields, key_values, map_blocks
from demandtide.operators.series import BLOCK
from demandtide.operators.windows import pack_blocks, unpack_blocks
from demandtide.session import scratch_dir


def _fold_size(n_splits: int, test_size: int | None) -> Column:
    return F.lit(test_size).cast("bigint") if test_size else F.floor(F.col("n") / (n_splits + 1)).cast("bigint")


def _half() -> Column:
    return F.floor(F.col("n") / 2).cast("bigint")


def fold_table(series: DataFrame, keys: Sequence[str] = (), n_splits: int = 5, test_size: int | None = None) -> DataFrame:
    """``keys, fold, train_end, test_end``: training from 0 to ``train_end``, test up to ``test_end``.

    Training starts with half of the data, so fewer than ``n_splits`` folds may fit.
    Reads one row per series; nothing is counted.
    """
    size = _fold_size(n_splits, test_size)
    return (
        series.where(F.col("idx") == 0)
        .select(*keys, "n", size.alias("size"), F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))).alias("i"))
        .select(*keys, "n", "size", (F.col("i") + 1).alias("fold"), (_half() + F.col("i") * F.col("size")).alias("train_end"))
        .withColumn("test_end", F.col("train_end") + F.col("size"))
        .where((F.col("size") > 0) & (F.col("test_end") <= F.col("n")))
        .select(*keys, "fold", "train_end", "test_end")
    )


def test_fold(n_splits: int = 5, test_size: int | None = None) -> Column:
    """The fold whose test part holds a row, else NULL. Test parts do not overlap, so this is arithmetic."""
    size = _fold_size(n_splits, test_size)
    i = F.floor((F.col("idx") - _half()) / F.nullif(size, F.lit(0)))
    fits = (F.col("idx") >= _half()) & (i < n_splits) & (_half() + (i + 1) * size <= F.col("n"))
    return F.when(fits, (i + 1).cast("int"))


def expand_folds(series: DataFrame, keys: Sequence[str] = (), n_splits: int = 5, test_size: int | None = None) -> DataFrame:
    """A copy of the series per fold, cut at the end of its test part.

    The result is a series keyed by ``keys + fold`` with ``cut`` at the first test row, so
    every forecaster runs on it as it stands. At most ``n_splits`` copies per row, made
    from ``idx`` and ``n`` of the row alone.
    """
    size = F.nullif(_fold_size(n_splits, test_size), F.lit(0).cast("bigint"))
    first = F.greatest(F.floor((F.col("idx") - _half()) / size), F.lit(0))
    last = F.least(F.floor((F.col("n") - _half()) / size), F.lit(n_splits)) - 1
    fold = F.explode(F.when(first <= last, F.sequence(first, last)))
    rows = series.select(*keys, "ts", "idx", "n", "y", size.alias("size"), fold.alias("i"))
    train_end = _half() + F.col("i") * F.col("size")
    return rows.select(
        *keys, (F.col("i") + 1).cast("int").alias("fold"), "ts", "idx", (train_end + F.col("size")).alias("n"), train_end.alias("cut"), "y"
    )


def walk_forward(
    series: DataFrame,
    forecaster: Callable[[DataFrame, list[str]], DataFrame],
    keys: Sequence[str] = (),
    n_splits: int = 5,
    test_size: int | None = None,
    refit: bool = True,
) -> DataFrame:
    """RMSE per key and fold.

    ``forecaster(table, keys)`` returns the rows with a column ``pred``. With ``refit`` it
    gets the fold copies (see ``expand_folds``) and trains on ``idx < cut`` of each. A
    forecaster that uses only earlier actuals gives the same for every fold; with
    ``refit=False`` it runs once on the plain series.
    """
    keys = list(keys)
    if refit:
        out = forecaster(expand_folds(series, keys, n_splits, test_size), [*keys, "fold"])
        rows = out.where(F.col("idx") >= F.col("cut"))
    else:
        rows = forecaster(series, keys).withColumn("fold", test_fold(n_splits, test_size)).where(F.col("fold").isNotNull())
    return rows.groupBy(*keys, "fold").agg(rmse(F.col("y"), F.col("pred")).alias("rmse"))


def summarize_folds(fold_scores: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean and population deviation over the folds."""
    return fold_scores.groupBy(*keys).agg(F.avg("rmse").alias("mean_rmse"), F.stddev_pop("rmse").alias("std_rmse"))


class BlockModel(Protocol):
    """A model that is fitted piece by piece, so that no task ever needs a whole series.

    States and parameters are flat arrays of numbers. ``merge`` gets pieces in the order of time.
    """

    def start(self) -> np.ndarray: ...

    def update(self, state: np.ndarray, idx: np.ndarray, y: np.ndarray) -> np.ndarray: ...

    def merge(self, earlier: np.ndarray, later: np.ndarray) -> np.ndarray: ...

    def finish(self, state: np.ndarray) -> np.ndarray: ...

    def predict(self, params: np.ndarray, idx: np.ndarray) -> np.ndarray: ...


@dataclass(frozen=True)
class PhaseMeans:
    """The mean of each phase of a period: a small example of a ``BlockModel``. NaN where a phase has no value."""

    period: int = 24

    def start(self) -> np.ndarray:
        return np.zeros(2 * self.period)

    def update(self, state: np.ndarray, idx: np.ndarray, y: np.ndarray) -> np.ndarray:
        phase = idx % self.period
        return state + np.concatenate([np.bincount(phase, y, self.period), np.bincount(phase, minlength=self.period)])

    def merge(self, earlier: np.ndarray, later: np.ndarray) -> np.ndarray:
        return earlier + later

    def finish(self, state: np.ndarray) -> np.ndarray:
        total, count = np.split(state, 2)
        return np.divide(total, count, out=np.full(self.period, np.nan), where=count > 0)

    def predict(self, params: np.ndarray, idx: np.ndarray) -> np.ndarray:
        return params[idx % self.period]


def block_forecaster(model: BlockModel, block: int = BLOCK, fan: int = 64) -> Callable[[DataFrame, list[str]], DataFrame]:
    """Turn a mergeable model into a forecaster for series of any length, also for ``walk_forward``.

    Every block of the training part makes a state; states are merged ``fan`` at a time, level by
    level, so no task holds more than ``fan`` of them. Test blocks are predicted side by side. Rows
    without a value take no part in the fit.
    """

    def forecaster(table: DataFrame, keys: list[str]) -> DataFrame:
        keys = list(keys)
        made = [T.StructField("blk", T.LongType()), T.StructField("state", DOUBLES)]
        schema = T.StructType(key_fields(table, keys) + made)

        def fit(row) -> Iterable[dict]:
            idx, y = np.asarray(row.places), np.asarray(row.values, dtype=float)
            known = ~np.isnan(y)
            yield {**key_values(row, keys), "blk": row.blk, "state": model.update(model.start(), idx[known], y[known])}

        def merged(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("blk")
            state = reduce(model.merge, (np.asarray(s, dtype=float) for s in pdf["state"]))
            return pdf[[*keys, "blk"]].iloc[:1].assign(blk=pdf["blk"].iloc[0] // fan, state=[state])

        train = pack_blocks(train_rows(table), keys, block=block, along=["ts"]).withColumn("places", F.col("rows.idx")).drop("rows")
        states = _written(map_blocks(train, fit, schema))
        last = states.agg(F.max("blk")).first()[0]
        while last:
            states = _written(states.groupBy(*keys, F.floor(F.col("blk") / fan).alias("_group")).applyInPandas(merged, schema))
            last //= fan

        @F.pandas_udf(DOUBLES)
        def predict(places: pd.Series, state: pd.Series) -> pd.Series:
            return pd.Series([model.predict(model.finish(np.asarray(s, dtype=float)), np.asarray(p)) for p, s in zip(places, state)])

        test = pack_blocks(test_rows(table), keys, block=block, along=["ts", "cut", "y"])
        with_state = attach(test, states, keys, ["state"])
        out = with_state.withColumn("made", predict(F.col("rows.idx"), "state"))
        rows = unpack_blocks(out, keys, ["ts", "cut", "y"], F.col("made"), "pred", block)
        return rows.withColumn("pred", F.when(~F.isnan("pred"), F.col("pred")))

    return forecaster


def _written(states: DataFrame) -> DataFrame:
    path = scratch_dir(states.sparkSession, "states")
    states.write.parquet(path)
    return states.sparkSession.read.schema(states.schema).parquet(path)


def pandas_forecaster(func: Callable[[pd.DataFrame, pd.DataFrame], np.ndarray]) -> Callable[[DataFrame, list[str]], DataFrame]:
    """Wrap a user's ``func(train, test) -> predictions`` for ``walk_forward``.

    The function sees one series of one fold at a time, as ``ts, y`` frames, and must
    take it whole: use it for series that fit in a task, and ``block_forecaster`` beyond.
    """

    def forecaster(table: DataFrame, keys: list[str]) -> DataFrame:
        def one(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("idx")
            train, test = pdf[pdf.idx < pdf.cut], pdf[pdf.idx >= pdf.cut]
            pred = func(train[["ts", "y"]].reset_index(drop=True), test[["ts", "y"]].reset_index(drop=True))
            return test.assign(pred=np.asarray(pred, dtype=float))

        cols = [*keys, "ts", "idx", "n", "cut", "y"]
        schema = table.select(*cols).withColumn("pred", F.lit(0.0)).schema
        return table.select(*cols).groupBy(*keys).applyInPandas(one, schema)

    return forecaster
