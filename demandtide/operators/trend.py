"""Forecast by a bending trend line plus daily and weekly waves, as a ridge regression."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandtide.operators.attach import attach
from demandtide.operators.features import train_rows, with_target
from demandtide.operators.gram import gram, least_squares, solve
from demandtide.operators.numeric import DOUBLES, key_fields, key_values, map_blocks
from demandtide.operators.series import BLOCK
from demandtide.operators.windows import pack_blocks

# (period in rows, number of waves): a day and a week of hours.
SEASONS = ((24, 4), (168, 3))
KNOTS = 25
KNOT_RANGE = 0.8
PENALTY = 10.0
PENALTIES = (0.01, 1.0, 10.0, 100.0)


def _waves(seasons: Sequence[tuple[int, int]]) -> list[float]:
    """Cycles per row, one entry per wave."""
    return [k / period for period, count in seasons for k in range(1, count + 1)]


def _design(idx: np.ndarray, cut: int, freqs: np.ndarray, knots: np.ndarray) -> np.ndarray:
    """Columns: 1, time (0..1 over training), sin and cos of each wave, hinges."""
    t = idx / max(cut - 1, 1)
    angle = 2 * np.pi * np.outer(idx, freqs)
    waves = np.stack([np.sin(angle), np.cos(angle)], axis=2).reshape(len(idx), -1)
    return np.column_stack([np.ones(len(idx)), t, waves, np.maximum(t[:, None] - knots, 0)])


def _blocks_design(freqs: np.ndarray, places: np.ndarray):
    """The regression's columns and values of one block."""

    def design(row):
        y = np.asarray(row.values, dtype=float)
        return _design(np.arange(len(y)) + int(row.at), int(row.cut), freqs, places), y

    return design


def _coefficients(m: np.ndarray, penalty: float, knots: int) -> np.ndarray:
    """Ridge solution from [X y]'[X y]; only the bends are penalized."""
    weight = np.zeros(m.shape[0] - 1)
    weight[-knots:] = penalty
    try:
        return least_squares(m, weight)[0]
    except np.linalg.LinAlgError:
        return np.linalg.lstsq(m[:-1, :-1] + np.diag(weight), m[:-1, -1], rcond=None)[0]


LINE = [T.StructField("intercept", T.DoubleType()), T.StructField("slope", T.DoubleType()), T.StructField("waves", DOUBLES)]


def _line(beta: np.ndarray, places: np.ndarray, waves: int) -> dict:
    """The line after the last bend, the one a forecast continues, and the waves."""
    bends = beta[-len(places) :]
    return {"intercept": float(beta[0] - bends @ places), "slope": float(beta[1] + bends.sum()), "waves": beta[2 : 2 + 2 * waves]}


def fit_trend(
    table: DataFrame,
    keys: Sequence[str] = (),
    seasons: Sequence[tuple[int, int]] = SEASONS,
    penalty: float = PENALTY,
    knots: int = KNOTS,
    block: int = BLOCK,
) -> DataFrame:
    """``keys, intercept, slope, waves`` from the rows before ``cut``."""
    keys = list(keys)
    freqs = np.asarray(_waves(seasons))
    places = KNOT_RANGE * np.arange(1, knots + 1) / knots
    blocks = pack_blocks(train_rows(table).where(F.col("cut") > 2), keys, block=block, carry=["cut"])

    def fit(m: np.ndarray, row) -> dict:
        return _line(_coefficients(m, penalty, knots), places, len(freqs))

    return solve(gram(blocks, keys, _blocks_design(freqs, places)), keys, fit, LINE)


def fit_tuned_trend(
    table: DataFrame,
    keys: Sequence[str] = (),
    seasons: Sequence[tuple[int, int]] = SEASONS,
    candidates: Sequence[float] = PENALTIES,
    n_splits: int = 5,
    knots: int = KNOTS,
    block: int = BLOCK,
) -> DataFrame:
    """``keys, penalty, mean_rmse, rmses, intercept, slope, waves``: the penalty with the smallest mean
    error over walk-forward folds of the training part, and the line it gives on all of that part.

    The rows are read once. Every stretch between two fold borders has its own sums of products; a
    fold trains on the sums of all stretches before its border and its error follows from those of the
    stretch behind it, whatever the penalty. The test part is never looked at. Bends that lie
    behind a fold's border have no rows and stay 0. Without a fold the middle candidate is taken.
    """
    keys = list(keys)
    freqs = np.asarray(_waves(seasons))
    places = KNOT_RANGE * np.arange(1, knots + 1) / knots
    half, size = F.floor(F.col("cut") / 2), F.floor(F.col("cut") / (n_splits + 1))
    stretch = F.when(F.col("idx") < half, 0).otherwise(F.least(F.floor((F.col("idx") - half) / F.nullif(size, F.lit(0))) + 1, F.lit(n_splits + 1)))
    rows = train_rows(table).where(F.col("cut") > 2).withColumn("stretch", F.coalesce(stretch, F.lit(n_splits + 1)))
    blocks = pack_blocks(rows, [*keys, "stretch"], block=block, carry=["cut"])
    sums = gram(blocks, [*keys, "stretch"], _blocks_design(freqs, places), ["cut"], {"cut": F.max("cut")})
    # At most n_splits + 2 matrices per key.
    parts = sums.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("stretch", "products"))).alias("parts"), F.max("size").alias("size"), F.max("cut").alias("cut"))

    def choose(row) -> Iterable[dict]:
        by = {int(p["stretch"]): np.asarray(p["products"], dtype=float).reshape(row.size, row.size) for p in row.parts}
        start, length = int(row.cut) // 2, int(row.cut) // (n_splits + 1)
        errors = []
        seen = by.get(0, np.zeros((row.size, row.size)))
        for fold in range(1, n_splits + 1):
            if length == 0 or start + fold * length > row.cut:
                break
            held = by.get(fold)
            if held is None:
                continue
            betas = [_coefficients(seen, p, knots) for p in candidates]
            errors.append([float(np.sqrt(max(held[-1, -1] - 2 * b @ held[:-1, -1] + b @ held[:-1, :-1] @ b, 0.0) / held[0, 0])) for b in betas])
            seen = seen + held
        means = np.mean(errors, axis=0) if errors else None
        best = int(np.argmin(means)) if errors else len(candidates) // 2
        beta = _coefficients(sum(by.values()), candidates[best], knots)
        yield {**key_values(row, keys), "penalty": float(candidates[best]), "mean_rmse": None if means is None else float(means[best]), "rmses": means, **_line(beta, places, len(freqs))}

    found = [T.StructField("penalty", T.DoubleType()), T.StructField("mean_rmse", T.DoubleType()), T.StructField("rmses", DOUBLES)]
    return map_blocks(parts, choose, T.StructType(key_fields(parts, keys) + found + LINE))


def trend_forecast(
    table: DataFrame,
    keys: Sequence[str] = (),
    seasons: Sequence[tuple[int, int]] = SEASONS,
    penalty: float | None = PENALTY,
    block: int = BLOCK,
    value: str = "y",
) -> DataFrame:
    """Fit on ``idx < cut``; the rest of the rows with ``pred``, in plain expressions.

    ``penalty`` None chooses one per key (see ``fit_tuned_trend``) and adds it as a column.
    """
    table = with_target(table, value)
    tuned = ["penalty", "mean_rmse"] if penalty is None else []
    fitted = fit_trend(table, keys, seasons, penalty, block=block) if penalty is not None else fit_tuned_trend(table, keys, seasons, block=block)
    ahead = attach(table.where(F.col("idx") >= F.col("cut")), fitted, keys, ["intercept", "slope", "waves", *tuned])
    pred = F.col("intercept") + F.col("slope") * F.col("idx") / F.greatest(F.col("cut") - 1, F.lit(1))
    for i, f in enumerate(_waves(seasons)):
        angle = F.lit(2 * np.pi * f) * F.col("idx")
        pred = pred + F.col("waves")[2 * i] * F.sin(angle) + F.col("waves")[2 * i + 1] * F.cos(angle)
    return ahead.withColumn("pred", pred).where(F.col("pred").isNotNull()).drop("intercept", "slope", "waves")
