"""Anomaly scores: thresholds, flags, summaries, chart tables.

A score table has ``keys, method, ts, idx, n, y, score``. A score belongs to a window
of ``length`` rows and sits at its last row; the rows before the first complete window
score 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandtide.functions.calendar import monday_first
from demandtide.operators.attach import attach
from demandtide.operators.features import norm_params, normalize, with_target
from demandtide.operators.quantiles import exact_percentile
from demandtide.operators.series import BLOCK
from demandtide.operators.windows import last_rows, over_time


def has_window(length: int = 24) -> Column:
    return F.col("idx") >= length - 1


def window_mean_error(errors: DataFrame, method: str, keys: Sequence[str] = (), length: int = 24, block: int = BLOCK) -> DataFrame:
    """Score = mean of the column ``err`` over the window."""
    scored = over_time(
        errors, keys, lambda w: {"m": F.avg("err").over(w.rowsBetween(-(length - 1), 0))}, before=length - 1, block=block
    )
    return scored.select(
        *keys, F.lit(method).alias("method"), "ts", "idx", "n", "y", F.when(has_window(length), F.col("m")).otherwise(F.lit(0.0)).alias("score")
    )


def profile_scores(series: DataFrame, keys: Sequence[str] = (), length: int = 24, method: str = "profile", value: str = "y") -> DataFrame:
    """How far a window of normalized values is from the usual (weekday, hour) values."""
    keys = list(keys)
    series = with_target(series, value)
    z = normalize(series, norm_params(series, keys), keys).select(
        *keys, "ts", "idx", "n", "y", "z", monday_first(F.col("ts")).alias("dow"), F.hour("ts").alias("hour")
    )
    usual = z.groupBy(*keys, "dow", "hour").agg(F.avg("z").alias("usual"))
    err = (F.col("z") - F.col("usual")) * (F.col("z") - F.col("usual"))
    errors = z.join(usual, [*keys, "dow", "hour"]).select(*keys, "ts", "idx", "n", "y", err.alias("err"))
    return window_mean_error(errors, method, keys, length)


def flag_scores(scores: DataFrame, keys: Sequence[str] = (), percentile: float = 95, length: int = 24) -> DataFrame:
    """Add ``threshold`` (percentile over complete windows) and ``is_anomaly`` (strictly above)."""
    by = [*keys, "method"]
    cut = exact_percentile(scores.where(has_window(length)), by, "score", percentile / 100)
    return attach(scores, cut, by, ["threshold"]).withColumn(
        "is_anomaly", has_window(length) & (F.col("score") > F.col("threshold"))
    )


def anomaly_points(flagged: DataFrame) -> DataFrame:
    return flagged.where("is_anomaly")


def anomaly_summary(flagged: DataFrame, keys: Sequence[str] = (), length: int = 24) -> DataFrame:
    """Windows, anomalies and their share in percent."""
    hit = F.col("is_anomaly").cast("int")
    return (
        flagged.where(has_window(length))
        .groupBy(*keys, "method")
        .agg(F.count("*").alias("n"), F.sum(hit).alias("n_anom"), (F.avg(hit) * 100).alias("pct"))
    )


def display_flags(scores: DataFrame, keys: Sequence[str] = (), rows: int = 1000, percentile: float = 95) -> DataFrame:
    """Flags for a chart: last rows only, percentile over the positive scores among them."""
    by = [*keys, "method"]
    tail = last_rows(scores, rows)
    cut = exact_percentile(tail.where(F.col("score") > 0), by, "score", percentile / 100)
    return attach(tail, cut, by, ["threshold"], "left").withColumn(
        "flag", F.coalesce(F.col("score") > F.col("threshold"), F.lit(False))
    )


def score_chart(scores: DataFrame, keys: Sequence[str] = (), rows: int = 1000) -> DataFrame:
    """Score lines per method with their 95 % line."""
    return display_flags(scores, keys, rows).select(*keys, "method", "ts", "score", F.col("threshold").alias("p95"))


def widen_scores(scores: DataFrame, methods: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """``ts, trip_count, anomaly_score_<method> ...``; the methods are named, so no extra job finds them.

    ``trip_count`` keeps the type of ``y``: rescaled samples have fractions.
    """
    wide = scores.groupBy(*keys, "ts", F.col("y").alias("trip_count")).pivot("method", list(methods)).agg(F.first("score"))
    return wide.select(*keys, "ts", "trip_count", *[F.col(m).alias(f"anomaly_score_{m}") for m in methods])
