"""Augmented Dickey-Fuller test per series, with the lag chosen by AIC."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandtide.operators.attach import attach
from demandtide.operators.features import with_target
from demandtide.operators.gram import gram, solve
from demandtide.operators.series import BLOCK
from demandtide.operators.windows import differences, pack_blocks

# Response surfaces for a regression with a constant. P values after
# MacKinnon (1994), critical values after MacKinnon (2010).
TAU_MAX, TAU_MIN, TAU_STAR = 2.74, -18.83, -1.61
SMALL_P = (2.1659, 1.4412, 0.038269)
LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)
CRITICAL = {
    "cv1": (-3.43035, -6.5393, -16.786, -79.433),
    "cv5": (-2.86154, -2.8903, -4.234, -40.040),
    "cv10": (-2.56677, -1.5384, -2.809, 0.0),
}


def max_lag(n: int) -> int:
    """Schwert's rule, limited so that the regression keeps enough rows."""
    return min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2)


def p_value(tau: float) -> float:
    if tau > TAU_MAX:
        return 1.0
    if tau < TAU_MIN:
        return 0.0
    coef = SMALL_P if tau <= TAU_STAR else LARGE_P
    z = sum(c * tau**i for i, c in enumerate(coef))
    return 0.5 * math.erfc(-z / math.sqrt(2))


def critical_value(name: str, nobs: int) -> float:
    return sum(c / nobs**i for i, c in enumerate(CRITICAL[name]))


def _lag_rows(y: np.ndarray, at: int, first: int, lags: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows t >= first of [1, y(t-1), dy(t-1) .. dy(t-lags)] and dy(t); ``y[0]`` is position ``at``."""
    dy = np.diff(y)  # dy[i] belongs to position at + i + 1
    t = np.arange(max(first, at + lags + 1), at + len(y)) - at
    x = np.column_stack([np.ones(len(t)), y[t - 1], *[dy[t - 1 - k] for k in range(1, lags + 1)]])
    return x, dy[t - 1]


def _reach(n: str = "n"):
    """Rows before a block that the longest lag of a series of ``n`` rows looks back on."""
    return (F.ceil(12 * F.pow(F.col(n) / 100, F.lit(0.25))) + 2).cast("bigint")


def adf_test(series: DataFrame, keys: Sequence[str] = (), block: int = BLOCK, value: str = "y") -> DataFrame:
    """``tau, pvalue, usedlag, nobs, cv1, cv5, cv10, is_stationary, reason`` per key.

    All lag lengths are compared on the rows that have the longest lag. Their normal
    equations are leading parts of one matrix, so the data is read once; the chosen
    length then gets back the few rows at the series start it can also use. Every key has a
    row: where there is no test, its values are NULL and ``reason`` says why; without keys there is one
    row. A block also gets the rows before it that the longest lag of its own series needs, so
    series of any length are tested.
    """
    keys = list(keys)
    series = with_target(series, value)
    mean = series.groupBy(*keys).agg(F.avg("y").alias("mean"))
    centred = attach(series.na.drop(subset=["y"]), mean, keys, ["mean"]).select(*keys, "idx", "n", (F.col("y") - F.col("mean")).alias("y"))
    blocks = pack_blocks(centred.where(F.col("n") >= 6), keys, before=_reach(), block=block)
    # The first rows of a series, as far as they lie in this block.
    own = F.greatest(F.col("blk") * block - F.col("at"), F.lit(0)).cast("int")
    rows = F.least(_reach() - F.col("blk") * block, F.size("values") - own).cast("int")
    blocks = blocks.withColumn("head", F.when(rows > 0, F.struct("blk", F.slice("values", own + 1, F.greatest(rows, F.lit(1))).alias("v"))))

    def design(row):
        lags = max_lag(int(row.n))
        y = np.asarray(row.values, dtype=float)
        return _lag_rows(y, int(row.at), max(int(row.blk) * block, lags + 1), lags)

    sums = gram(blocks, keys, design, ["blk", "n", "head"], {"n": F.max("n"), "head": F.flatten(F.array_sort(F.collect_list("head")).getField("v"))})

    def none(reason: str) -> dict:
        return {**dict.fromkeys(["tau", "pvalue", "usedlag", "nobs", *CRITICAL, "is_stationary"]), "reason": reason}

    def test(m: np.ndarray, row) -> dict | None:
        lags = m.shape[0] - 3
        nobs = int(row.n) - 1 - lags
        try:
            r = np.linalg.cholesky(m[:-1, :-1])
        except np.linalg.LinAlgError:
            return none("no spread in the compared rows")
        u = np.linalg.solve(r, m[:-1, -1])
        ssr = m[-1, -1] - np.cumsum(u * u)[1:]  # entry l: lags 0..l
        if not np.all(ssr > 0):
            return none("no error left")
        count = np.arange(lags + 1)
        aic = nobs * (math.log(2 * math.pi) + np.log(ssr / nobs) + 1) + 2 * (count + 2)
        best = int(np.argmin(aic))
        pick = [*range(best + 2), m.shape[0] - 1]
        own = m[np.ix_(pick, pick)].copy()
        if best < lags:
            x, d = _lag_rows(np.asarray(row.head, dtype=float)[: lags + 1], 0, best + 1, best)
            extra = np.column_stack([x, d])
            own += extra.T @ extra
        nobs = int(row.n) - 1 - best
        try:
            inverse = np.linalg.inv(own[:-1, :-1])
        except np.linalg.LinAlgError:
            return none("no spread in the compared rows")
        beta = inverse @ own[:-1, -1]
        rest = float(own[-1, -1] - beta @ own[:-1, -1])
        df = nobs - (best + 2)
        if df <= 0 or rest <= 0:
            return none("no error left")
        tau = float(beta[1] / math.sqrt(rest / df * inverse[1, 1]))
        p = p_value(tau)
        return {
            "tau": tau,
            "pvalue": p,
            "usedlag": best,
            "nobs": nobs,
            **{name: critical_value(name, nobs) for name in CRITICAL},
            "is_stationary": p < 0.05,
            "reason": None,
        }

    doubles = ["cv1", "cv5", "cv10"]
    fields = (
        [T.StructField("tau", T.DoubleType()), T.StructField("pvalue", T.DoubleType())]
        + [T.StructField("usedlag", T.IntegerType()), T.StructField("nobs", T.LongType())]
        + [T.StructField(c, T.DoubleType()) for c in doubles]
        + [T.StructField("is_stationary", T.BooleanType()), T.StructField("reason", T.StringType())]
    )
    found = solve(sums, keys, test, fields)
    if not keys:
        # One row, whether or not the regression was reached.
        filled = found.agg(F.count("*").alias("_rows"), *[F.first(c).alias(c) for c in found.columns])
        return filled.withColumn("reason", F.when(F.col("_rows") == 0, "too short").otherwise(F.col("reason"))).drop("_rows")
    # Keys without six rows that hold a value never reach the regression.
    every = mean.select(*keys).join(found.withColumn("_there", F.lit(True)), keys, "left")
    return every.withColumn("reason", F.when(F.col("_there").isNull(), "too short").otherwise(F.col("reason"))).drop("_there")


def dickey_fuller(series: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The test without lags: a regression of ``dy`` on ``y_lag``, in plain aggregates. A series without
    spread or error left has NULL."""
    d = differences(series, keys)
    x, y = F.col("y_lag"), F.col("dy")
    sums = d.groupBy(*keys).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_sxx(y, x).alias("sxx"), F.regr_syy(y, x).alias("syy"), F.count("*").alias("m")
    )
    rest = F.col("syy") - F.col("slope") * F.col("slope") * F.col("sxx")
    able = (F.col("m") > 2) & (F.col("sxx") > 0) & (rest > 0)
    tau = F.when(able, F.col("slope") / F.sqrt(F.when(able, rest / (F.col("m") - 2) / F.col("sxx")))).alias("tau")
    if not keys:
        return sums.select(tau)
    # Series of one row have no difference.
    return series.select(*keys).distinct().join(sums.select(*keys, tau), list(keys), "left")
