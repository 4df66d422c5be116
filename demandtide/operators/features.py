"""Calendar features, normalization and the hold-out split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandtide.functions.calendar import calendar_columns
from demandtide.operators.attach import attach


def calendar_features(series: DataFrame, ts_col: str = "ts") -> DataFrame:
    return series.select("*", *[c.alias(name) for name, c in calendar_columns(F.col(ts_col)).items()])


def with_target(series: DataFrame, value: str = "y") -> DataFrame:
    """The series with the column ``value`` as its target ``y``."""
    return series if value == "y" else series.withColumn("y", F.col(value).cast("double"))


def with_cut(series: DataFrame, test_size: float = 0.2) -> DataFrame:
    """Add ``cut``, the position of the first test row: the whole part of ``n * (1 - test_size)``.

    The cut comes from ``n``, so the split needs no sort and no count.
    """
    return series.withColumn("cut", F.floor(F.col("n") * F.lit(1 - test_size)).cast("bigint"))


def is_train() -> Column:
    return F.col("idx") < F.col("cut")


def with_split(series: DataFrame, test_size: float = 0.2) -> DataFrame:
    """Add ``cut`` and the label ``split``: train before the cut, test from there on."""
    return with_cut(series, test_size).withColumn("split", F.when(is_train(), "train").otherwise("test"))


def train_rows(series: DataFrame) -> DataFrame:
    return series.where(is_train())


def test_rows(series: DataFrame) -> DataFrame:
    return series.where(~is_train())


def norm_params(series: DataFrame, keys: Sequence[str] = (), fit_on: str = "all", test_size: float = 0.2, value: str = "y") -> DataFrame:
    """Mean and sample deviation per key, over the whole series or its training part."""
    if fit_on not in ("all", "train"):
        raise ValueError("fit_on must be 'all' or 'train'")
    base = train_rows(with_cut(series, test_size)) if fit_on == "train" else series
    return base.groupBy(*keys).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))


def normalize(df: DataFrame, params: DataFrame, keys: Sequence[str] = (), value: str = "y", name: str = "z") -> DataFrame:
    """``(value - mean) / std``; NULL where the deviation is 0."""
    out = attach(df, params, keys, ["mean", "std"])
    return out.withColumn(name, (F.col(value) - F.col("mean")) / F.nullif(F.col("std"), F.lit(0.0))).drop("mean", "std")


def denormalize(df: DataFrame, params: DataFrame, keys: Sequence[str] = (), value: str = "z", name: str = "y_back") -> DataFrame:
    out = attach(df, params, keys, ["mean", "std"])
    return out.withColumn(name, F.col(value) * F.col("std") + F.col("mean")).drop("mean", "std")


def regression_frame(series: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Training frame in the ``ds, y`` naming."""
    return series.select(*keys, F.col("ts").alias("ds"), "y")


def future_frame(series: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return series.select(*keys, F.col("ts").alias("ds"))


def drop_missing(series: DataFrame, value: str = "y") -> DataFrame:
    return series.na.drop(subset=[value])
