"""Holt-Winters exponential smoothing with additive trend and season."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandtide.operators.attach import attach
from demandtide.operators.features import train_rows, with_target
from demandtide.operators.numeric import DOUBLES, key_fields, key_values, map_block_groups, map_blocks
from demandtide.operators.recursion import block_starts, last_block, state_of, with_starts
from demandtide.operators.windows import pack_blocks

Params = tuple[float, float, float]

# Rows run in one go: seven and a half years of hours. Each further block of a series
# costs one state per parameter set, so blocks are long here.
RUN_BLOCK = 65_520

# Level, trend and season weights tried when none are given.
GRID: tuple[Params, ...] = tuple(product((0.02, 0.05, 0.1, 0.2, 0.4, 0.7), (0.0, 0.01, 0.05, 0.1), (0.02, 0.05, 0.1, 0.3)))


# Series run abreast: the state of 32 series and 96 parameter sets is about 600 KB.
ABREAST = 32


def _first_state(y: np.ndarray, sets: int, m: int) -> np.ndarray:
    """Level, trend and season from the first two periods, once per parameter set."""
    level = y[:m].mean()
    trend = (y[m : 2 * m].mean() - level) / m
    return np.tile(np.concatenate([[level, trend], y[:m] - level]), (sets, 1))


def _smooth(series: Sequence[np.ndarray], starts: np.ndarray, params: np.ndarray, m: int, keep: bool = False):
    """Run all parameter sets over several series at once.

    Returns end states, sums of squared errors and, with ``keep``, one-step predictions.
    A state is level, trend, then the season by ``position mod m``; every series begins at
    a multiple of ``m``. ``starts`` is (series, sets, state).
    """
    alpha, beta, gamma = params.T
    # Longest first: at any time the series still running are the first few.
    order = sorted(range(len(series)), key=lambda r: -len(series[r]))
    longest = len(series[order[0]])
    values = np.zeros((longest, len(series)))
    for place, r in enumerate(order):
        values[: len(series[r]), place] = series[r]
    running = np.searchsorted(-np.array([len(series[r]) for r in order]), -np.arange(longest), side="left")
    states = starts[order]
    level, trend, season = states[..., 0].copy(), states[..., 1].copy(), states[..., 2:].transpose(2, 0, 1).copy()
    sse = np.zeros(level.shape)
    preds = np.empty((longest, *level.shape)) if keep else None
    for i in range(longest):
        live = running[i]
        s = season[i % m, :live]
        value = values[i, :live, None]
        base = level[:live] + trend[:live]
        pred = base + s
        if keep:
            preds[i, :live] = pred
        err = value - pred
        sse[:live] += err * err
        new = base + alpha * err
        trend[:live] = beta * (new - level[:live]) + (1 - beta) * trend[:live]
        s += gamma * (value - new - s)
        level[:live] = new
    ends = np.concatenate([level[..., None], trend[..., None], season.transpose(1, 2, 0)], axis=2)
    back = np.argsort(order)
    return ends[back], sse[back], preds[:, back] if keep else None


def _transition(params: np.ndarray, m: int, block: int) -> np.ndarray:
    """How a start state carries through one full block, (sets, state, state)."""
    size = m + 2
    unit = np.repeat(np.eye(size)[:, None, :], len(params), axis=1)
    one = _smooth([np.zeros(m)] * size, unit, params, m)[0].transpose(1, 2, 0)
    out = np.repeat(np.eye(size)[None], len(params), axis=0)
    for bit in bin(block // m)[2:]:
        out = out @ out
        if bit == "1":
            out = one @ out
    return out


def _training_blocks(table: DataFrame, keys: Sequence[str], params: np.ndarray, m: int, block: int) -> DataFrame:
    """Training rows as blocks with their start states, one per parameter set."""
    block = max(block - block % m, 2 * m)
    packed = pack_blocks(train_rows(table).where(F.col("cut") >= 2 * m), keys, block=block, carry=["cut"])
    blocks = packed.withColumn("more", F.col("blk") < last_block("cut", block))

    def end(row) -> np.ndarray:
        y = np.asarray(row.values, dtype=float)
        start = _first_state(y, len(params), m) if row.blk == 0 else np.zeros((len(params), m + 2))
        return _smooth([y], start[None], params, m)[0][0]

    starts = block_starts(blocks, keys, end, lambda row: _transition(params, m, block))
    return with_starts(blocks, starts, keys)


def _start(row, y: np.ndarray, sets: int, m: int) -> np.ndarray:
    given = state_of(row, sets)
    return _first_state(y, sets, m) if given is None else given


def smoothed(table: DataFrame, keys: Sequence[str] = (), params: Params = (0.3, 0.05, 0.1), period: int = 24, block: int = RUN_BLOCK) -> DataFrame:
    """One-step-ahead predictions on the rows before ``cut``: ``keys, idx, y, pred``."""
    keys, one = list(keys), np.asarray([params], dtype=float)
    blocks = _training_blocks(table, keys, one, period, block)
    schema = T.StructType(key_fields(table, keys) + [T.StructField("at", T.LongType()), T.StructField("y", DOUBLES), T.StructField("pred", DOUBLES)])

    def whole(row):
        y = np.asarray(row.values, dtype=float)
        _, _, preds = _smooth([y], _start(row, y, 1, period)[None], one, period, keep=True)
        yield {**key_values(row, keys), "at": int(row.at), "y": y, "pred": preds[:, 0, 0]}

    # A block leaves Python as two arrays; the rows are made on Spark's side.
    made = map_blocks(blocks, whole, schema).select(*keys, "at", F.posexplode(F.arrays_zip("y", "pred")).alias("place", "z"))
    return made.select(*keys, (F.col("at") + F.col("place")).alias("idx"), F.col("z.y").alias("y"), F.col("z.pred").alias("pred"))


def fit_smoothing(
    table: DataFrame, keys: Sequence[str] = (), grid: Sequence[Params] = GRID, period: int = 24, block: int = RUN_BLOCK
) -> DataFrame:
    """Best parameters per key on the rows before ``cut``, with the state at the cut.

    ``keys, alpha, beta, gamma, sse, level, trend, season``. The season is listed by
    ``idx mod period``. Series shorter than two periods have no row.
    """
    keys, params = list(keys), np.asarray(grid, dtype=float)
    blocks = _training_blocks(table, keys, params, period, block)
    schema = T.StructType(
        key_fields(table, keys)
        + [T.StructField("blk", T.LongType()), T.StructField("place", T.IntegerType())]
        + [T.StructField("sse", T.DoubleType()), T.StructField("state", DOUBLES)]
    )

    def tried(rows):
        ys = [np.asarray(row.values, dtype=float) for row in rows]
        starts = np.stack([_start(row, y, len(params), period) for row, y in zip(rows, ys)])
        ends, sse, _ = _smooth(ys, starts, params, period)
        for r, row in enumerate(rows):
            base = {**key_values(row, keys), "blk": row.blk}
            alone = row.blk == 0 and not row.more
            # A series of one block is decided here; only the last block's state matters.
            for p in [int(np.argmin(sse[r]))] if alone else range(len(params)):
                yield {**base, "place": p, "sse": sse[r, p], "state": None if row.more else ends[r, p]}

    per_set = (
        map_block_groups(blocks, tried, schema, ABREAST)
        .groupBy(*keys, "place")
        .agg(F.sum("sse").alias("sse"), F.max_by("state", "blk").alias("state"))
    )
    best = per_set.groupBy(*keys).agg(F.min_by(F.struct("place", "sse", "state"), F.struct("sse", "place")).alias("b"))
    weights = F.array(*[F.array(*[F.lit(float(v)) for v in p]) for p in grid])
    chosen = F.get(weights, F.col("b.place"))
    return best.where(F.col("b").isNotNull()).select(
        *keys,
        chosen[0].alias("alpha"),
        chosen[1].alias("beta"),
        chosen[2].alias("gamma"),
        F.col("b.sse").alias("sse"),
        F.col("b.state")[0].alias("level"),
        F.col("b.state")[1].alias("trend"),
        F.slice(F.col("b.state"), 3, period).alias("season"),
    )


def forecast_smoothing(table: DataFrame, fitted: DataFrame, keys: Sequence[str] = (), period: int = 24) -> DataFrame:
    """Forecast every row from ``cut`` on: level, trend times distance, last season."""
    ahead = attach(table.where(F.col("idx") >= F.col("cut")), fitted, keys, ["alpha", "beta", "gamma", "sse", "level", "trend", "season"])
    ahead = ahead.where(F.col("level").isNotNull())  # without keys a missing fit is a row of NULLs
    steps = F.col("idx") - F.col("cut") + 1
    season = F.get("season", (F.col("idx") % period).cast("int"))
    return ahead.withColumn("pred", F.col("level") + F.col("trend") * steps + season).drop("level", "trend", "season")


def holt_winters(
    table: DataFrame, keys: Sequence[str] = (), grid: Sequence[Params] = GRID, period: int = 24, block: int = RUN_BLOCK, value: str = "y"
) -> DataFrame:
    """Fit on ``idx < cut`` and forecast the rest: the rows with ``pred, alpha, beta, gamma, sse``."""
    table = with_target(table, value)
    return forecast_smoothing(table, fit_smoothing(table, keys, grid, period, block), keys, period)
