"""Training step by step: a linear lag model by Adam, with its loss on both splits after every epoch.

Squared loss over all windows is a function of their sums of products alone. Each block adds up
its own small matrix, once for the training and once for the test part; Spark sums them. All
epochs then run on the two matrices, so the log is read once whatever the number of epochs, and
one epoch is one step on the loss of the whole training part.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandtide.operators.attach import attach
from demandtide.operators.features import denormalize, norm_params, normalize, with_split, with_target
from demandtide.operators.gram import gram
from demandtide.operators.numeric import DOUBLES, map_blocks
from demandtide.operators.series import BLOCK
from demandtide.operators.windows import pack_blocks, supervised_windows

EPOCHS, RATE = 50, 0.02
# Adam's customary fading rates and floor (Kingma and Ba 2015).
FADE, FADE_SQUARES, FLOOR = 0.9, 0.999, 1e-8

EPOCH = T.StructType(
    [T.StructField("epoch", T.IntegerType()), T.StructField("train_loss", T.DoubleType()), T.StructField("test_loss", T.DoubleType()), T.StructField("weights", DOUBLES)]
)


def _scaled(series: DataFrame, keys: Sequence[str], test_size: float, value: str) -> tuple[DataFrame, DataFrame]:
    """Values normalized per key by the training part, and the parameters; a constant key is all zeros."""
    series = with_target(series, value)
    params = norm_params(series, keys, "train", test_size).withColumn("std", F.coalesce("std", F.lit(0.0)))
    z = with_split(normalize(series, params, keys), test_size).where(F.col("y").isNotNull())
    return z.withColumn("z", F.coalesce("z", F.lit(0.0))), params


def lag_products(z: DataFrame, keys: Sequence[str] = (), length: int = 24, block: int = BLOCK) -> DataFrame:
    """``split, size, products``: sums over all windows of all keys; no window crosses the split."""
    blocks = pack_blocks(z, [*keys, "split"], "z", before=length, block=block)

    def design(row):
        v = np.asarray(row.values, dtype=float)
        first = max(int(row.blk) * block - int(row.at), length)
        if first >= len(v):
            return None
        x = np.lib.stride_tricks.sliding_window_view(v[first - length : -1], length)
        return np.column_stack([np.ones(len(x)), x]), v[first:]

    return gram(blocks, ["split"], design)


def _loss(m: np.ndarray, b: np.ndarray) -> float | None:
    """Mean squared error of weights ``b`` from [1 x z]'[1 x z]."""
    return None if m is None else float((m[-1, -1] - 2 * b @ m[:-1, -1] + b @ m[:-1, :-1] @ b) / m[0, 0])


def train(products: DataFrame, epochs: int = EPOCHS, rate: float = RATE) -> DataFrame:
    """``epoch, train_loss, test_loss, weights`` after each epoch; no rows without a training window.

    The weights are the constant and those of the ``length`` values, oldest first; they start at 0.
    Without a window in the test part its loss is NULL.
    """
    part = lambda name: F.max_by("products", F.col("split") == name)
    has = lambda name: F.bool_or(F.col("split") == name)
    both = products.agg(
        F.max("size").alias("size"), F.when(has("train"), part("train")).alias("train"), F.when(has("test"), part("test")).alias("test")
    ).where(F.col("train").isNotNull())

    def run(row) -> Iterable[dict]:
        seen, held = (None if p is None else np.asarray(p, dtype=float).reshape(row.size, row.size) for p in (row.train, row.test))
        b = np.zeros(row.size - 1)
        speed, square = b, b
        for epoch in range(1, epochs + 1):
            gradient = 2 / seen[0, 0] * (seen[:-1, :-1] @ b - seen[:-1, -1])
            speed = FADE * speed + (1 - FADE) * gradient
            square = FADE_SQUARES * square + (1 - FADE_SQUARES) * gradient * gradient
            b = b - rate * (speed / (1 - FADE**epoch)) / (np.sqrt(square / (1 - FADE_SQUARES**epoch)) + FLOOR)
            yield {"epoch": epoch, "train_loss": _loss(seen, b), "test_loss": _loss(held, b), "weights": b}

    return map_blocks(both, run, EPOCH)


def fit_epochs(
    series: DataFrame, keys: Sequence[str] = (), length: int = 24, epochs: int = EPOCHS, rate: float = RATE, test_size: float = 0.2, value: str = "y", block: int = BLOCK
) -> DataFrame:
    """The epochs of one model over all series. Write ``series`` first: it is read for its scale and its sums."""
    z, _ = _scaled(series, keys, test_size, value)
    return train(lag_products(z, keys, length, block), epochs, rate)


def loss_history(epochs: DataFrame, model: str = "lag_adam") -> DataFrame:
    """``model, split, iteration, loss``, one row per epoch and split."""
    return (
        epochs.select(F.lit(model).alias("model"), F.col("epoch").alias("iteration"), F.col("train_loss").alias("train"), F.col("test_loss").alias("test"))
        .unpivot(["model", "iteration"], ["train", "test"], "split", "loss")
        .where(F.col("loss").isNotNull())
        .select("model", "split", "iteration", "loss")
    )


def epoch_forecast(series: DataFrame, epochs: DataFrame, keys: Sequence[str] = (), length: int = 24, test_size: float = 0.2, value: str = "y") -> DataFrame:
    """The test rows with ``pred``, one step ahead, by the weights of the last epoch.

    The first ``length`` test rows have no window of their own and no forecast.
    """
    z, params = _scaled(series, keys, test_size, value)
    windows = supervised_windows(z, keys, length, "z").where(F.col("split") == "test")
    rows = attach(windows, epochs.groupBy().agg(F.max_by("weights", "epoch").alias("weights")), (), ["weights"])
    products = F.zip_with(F.col("x"), F.slice("weights", 2, length), lambda x, w: x * w)
    rows = rows.withColumn("z_pred", F.aggregate(products, F.col("weights")[0], lambda a, v: a + v))
    return denormalize(rows, params, keys, "z_pred", "pred").drop("x", "z", "z_pred", "weights")


def save_epochs(epochs: DataFrame, path: str) -> None:
    """The model artifact: weights and losses of every epoch."""
    epochs.write.mode("overwrite").parquet(path)


def load_epochs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EPOCH).parquet(path)
