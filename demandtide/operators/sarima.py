"""Seasonal ARIMA of any order (p,d,q)(P,D,Q,period) by conditional least squares.

The lag polynomials are products of a plain and a seasonal one. Candidates are drawn as partial
autocorrelations, so every one of them is stationary and invertible whatever the order. The search
tries evenly spread candidates, keeps the best and halves the box around it, round after round. A
series that fits in one block is searched within its task. A longer one is searched over all its
blocks at once, each round being a few Spark stages (see ``recursion``); both ways try the same
candidates.

Without stated orders a series gets (2,1,2)(1,1,1,period), or (1,1,1) when it is short for that. There
is no constant term.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandtide.operators.attach import attach
from demandtide.operators.features import train_rows, with_target
from demandtide.operators.numeric import DOUBLES, key_fields, key_values, map_block_groups, map_blocks
from demandtide.operators.recursion import block_starts, last_block, state_of, with_starts
from demandtide.operators.windows import pack_blocks
from demandtide.session import scratch_dir

# Seven and a half years of hours: half a megabyte, searched within one task.
SEARCH_BLOCK = 65_520
ROUNDS = 5
CANDIDATES = 400
EDGE = 0.98
# Forecast steps that leave a task at once.
AHEAD_PIECE = 4032
# Series searched abreast, and time steps worked on at once: 8 * 400 * 256 errors are 7 MB.
ABREAST = 8
_PIECE = 256


def _from_partial(r: np.ndarray) -> list[np.ndarray]:
    """Weights of lags 1, 2, .. of the stationary recursion with partial autocorrelations ``r`` (last axis)."""
    weights: list[np.ndarray] = []
    for k in range(r.shape[-1]):
        last = r[..., k]
        weights = [w - last * back for w, back in zip(weights, reversed(weights))] + [last]
    return weights


@dataclass(frozen=True)
class Order:
    """A model order: which lags take part, and how many search numbers it has."""

    p: int
    d: int
    q: int
    seasonal_p: int = 0
    seasonal_d: int = 0
    seasonal_q: int = 0
    period: int = 1

    def __post_init__(self) -> None:
        counts = (self.p, self.d, self.q, self.seasonal_p, self.seasonal_d, self.seasonal_q)
        if min(counts) < 0 or self.period < 1 or (self.seasonal and self.period < 2):
            raise ValueError(f"no model order: {self}")

    @property
    def seasonal(self) -> bool:
        return self.seasonal_p + self.seasonal_d + self.seasonal_q > 0

    def _lags(self, plain: int, seasons: int) -> tuple[int, ...]:
        return tuple(i + self.period * j for j in range(seasons + 1) for i in range(plain + 1) if i + j)

    @property
    def ar_lags(self) -> tuple[int, ...]:
        return self._lags(self.p, self.seasonal_p)

    @property
    def ma_lags(self) -> tuple[int, ...]:
        return self._lags(self.q, self.seasonal_q)

    @property
    def dims(self) -> int:
        return self.p + self.q + self.seasonal_p + self.seasonal_q

    @property
    def lost(self) -> int:
        """Rows lost to differencing."""
        return self.d + self.period * self.seasonal_d

    @property
    def memory(self) -> int:
        return max((1, *self.ar_lags, *self.ma_lags))

    @property
    def margin(self) -> int:
        """Values that the first row of a block needs from before it."""
        return self.lost + self.memory

    @property
    def shortest(self) -> int:
        return max(4 * self.period if self.seasonal else 8, self.lost + 2 * self.memory + self.dims + 2)

    def difference(self, y: np.ndarray) -> np.ndarray:
        """Differenced values for ``y[lost:]``."""
        y = np.diff(y, self.d)
        for _ in range(self.seasonal_d):
            y = y[self.period :] - y[: -self.period]
        return y

    @property
    def undo(self) -> dict[int, float]:
        """Weights by lag of earlier values in a value, given its difference."""
        poly = np.ones(1)
        for step, times in ((1, self.d), (self.period, self.seasonal_d)):
            for _ in range(times):
                poly = np.concatenate([poly, np.zeros(step)]) - np.concatenate([np.zeros(step), poly])
        return {lag: -c for lag, c in enumerate(poly.tolist()) if lag and c}

    def coefficients(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """AR and MA weights by lag on the last axis, from search numbers in (-1, 1)."""
        parts = np.split(u, np.cumsum([self.p, self.q, self.seasonal_p]), axis=-1)
        phi, sphi = _from_partial(parts[0]), _from_partial(parts[2])
        # Invertible: the weights of a stationary recursion with the other sign.
        the, sthe = ([x if len(w) == 1 else -x for x in w] for w in map(_from_partial, (parts[1], parts[3])))
        a, m = list(phi), list(the)
        for own in sphi:
            a += [own, *[-x * own for x in phi]]
        for own in sthe:
            m += [own, *[x * own for x in the]]
        stack = lambda w: np.stack(w, axis=-1) if w else np.zeros((*u.shape[:-1], 0))
        return stack(a), stack(m)


def default_orders(period: int) -> tuple[Order, ...]:
    return Order(2, 1, 2, 1, 1, 1, period), Order(1, 1, 1)


def orders_of(order: Sequence[int] | None, seasonal_order: Sequence[int] | None, period: int) -> tuple[Order, ...]:
    """The stated order, ``(p, d, q)`` and ``(P, D, Q, period)``, or the default ones."""
    if order is None and seasonal_order is None:
        return default_orders(period)
    return (Order(*(order or (0, 0, 0)), *(seasonal_order or ())),)


def order_for(rows: int, orders: Sequence[Order]) -> Order | None:
    """The first order the series is long enough for."""
    return next((o for o in orders if rows >= o.shortest), None)


def strides(dims: int) -> np.ndarray:
    """Irrational steps whose multiples fill a cube of ``dims`` sides evenly (Roberts 2018)."""
    g = 2.0
    for _ in range(60):
        g = (1 + g) ** (1 / (dims + 1))
    return g ** -np.arange(1.0, dims + 1)


def candidates(center: np.ndarray, turn: int) -> np.ndarray:
    """Search numbers of one round, evenly spread over its box; the centre itself is the first."""
    place = np.arange(turn * CANDIDATES, (turn + 1) * CANDIDATES)[:, None]
    u = (0.5 + place * strides(len(center))) % 1
    out = center + EDGE * 0.5**turn * (2 * u - 1)
    out[0] = center
    return np.clip(out, -EDGE, EDGE)


def run_errors(
    order: Order, series: Sequence[np.ndarray], at: int, own: int, sets: np.ndarray, start: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Sum of squared errors over positions ``own`` and later, and the last errors.

    Several series run abreast, each with its own ``sets`` (series, sets, numbers). Their
    first value is position ``at``; enough rows before ``own`` are there, or the series
    start. ``start`` holds the errors before ``own``, oldest first, (series, sets, memory).
    Errors are 0 where the differenced series does not exist yet, and the first ``memory``
    do not count.
    """
    # Longest first: at any time the series still running are the first few.
    ranked = sorted(range(len(series)), key=lambda r: -len(series[r]))
    memory, first = order.memory, own - at
    counts = np.array([len(series[r]) - first for r in ranked])
    w = np.zeros((memory + first + counts[0], len(series)))  # row memory + i is position at + i
    for place, r in enumerate(ranked):
        if len(series[r]) > order.lost:
            w[memory + order.lost : memory + len(series[r]), place] = order.difference(series[r])
    a, m = (c[ranked] for c in order.coefficients(sets))
    ma = [m[..., j] for j in range(len(order.ma_lags))]
    errors = np.zeros((memory + _PIECE, *sets.shape[:2]))
    errors[:memory] = start[ranked].transpose(2, 0, 1)
    sse, ends = np.zeros(sets.shape[:2]), np.zeros(start.shape)
    for lo in range(0, counts[0], _PIECE):
        size = min(_PIECE, counts[0] - lo)
        rows = memory + first + lo + np.arange(size)
        u = np.repeat(w[rows].T[:, :, None], sets.shape[1], axis=2)  # (series, time, sets)
        if order.ar_lags:
            u -= np.stack([w[rows - lag] for lag in order.ar_lags], axis=-1).transpose(1, 0, 2) @ a.transpose(0, 2, 1)
        running = np.searchsorted(-counts, -(lo + np.arange(size)), side="left")
        for i in range(size):
            live = running[i]
            e = u[:live, i]
            for j, lag in enumerate(order.ma_lags):
                e -= ma[j][:live] * errors[memory + i - lag, :live]
            errors[memory + i, :live] = e
        skip = max(order.lost + memory - (own + lo), 0)  # rows of this piece that do not count
        for place, count in enumerate(counts):
            stop = min(count - lo, size)
            if stop > skip:
                part = errors[memory + skip : memory + stop, place]
                sse[place] += np.einsum("tp,tp->p", part, part)
            if 0 < stop == count - lo:
                ends[place] = errors[stop : stop + memory, place].T
        errors[:memory] = errors[size : size + memory].copy()
    back = np.argsort(ranked)
    return sse[back], ends[back]


def _carry_over(order: Order, sets: np.ndarray, block: int) -> np.ndarray:
    """How the last errors carry through a full block, (sets, memory, memory)."""
    _, m = order.coefficients(sets)
    size = order.memory
    one = np.zeros((len(sets), size, size))
    one[:, np.arange(size - 1), np.arange(1, size)] = 1.0
    for j, lag in enumerate(order.ma_lags):
        one[:, -1, size - lag] -= m[:, j]
    out = np.repeat(np.eye(size)[None], len(sets), 0)
    for bit in bin(block)[2:]:
        out = out @ out
        if bit == "1":
            out = out @ one
    return out


def search(order: Order, series: Sequence[np.ndarray]) -> list[tuple[np.ndarray, float, np.ndarray]]:
    """Best search numbers, their sum of squares and last errors, for series held whole."""
    centers = np.zeros((len(series), order.dims))
    for turn in range(ROUNDS):
        sets = np.stack([candidates(c, turn) for c in centers])
        scores, ends = run_errors(order, series, 0, 0, sets, np.zeros((*sets.shape[:2], order.memory)))
        best = scores.argmin(axis=1)
        each = np.arange(len(series))
        centers, found = sets[each, best], (scores[each, best], ends[each, best])
    return [(centers[r], float(found[0][r]), found[1][r]) for r in range(len(series))]


def _model_fields() -> list[T.StructField]:
    return [
        T.StructField("cut", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("params", DOUBLES),
        T.StructField("sse", T.DoubleType()),
        T.StructField("tail", DOUBLES),
        T.StructField("errors", DOUBLES),
    ]


def fit_sarima(
    table: DataFrame, keys: Sequence[str] = (), orders: Sequence[Order] = default_orders(24), block: int = SEARCH_BLOCK, long_series: bool | None = None
) -> DataFrame:
    """``keys, cut, n, params, sse, tail, errors``: what a forecast needs, one row per series.

    A series gets the first of ``orders`` it is long enough for; one longer than ``block`` the first of all.

    ``long_series`` says whether a series has more than ``block`` training rows; None
    looks it up, which costs one pass over ``table``. Give a written or cached series.
    """
    keys = list(keys)
    if orders[0].margin > block or orders[0].shortest > block:
        raise ValueError("a block must hold what the order looks back on")
    series = table.where(F.col("cut") >= min(o.shortest for o in orders))
    if long_series is None:
        long_series = not series.where((F.col("idx") == 0) & (F.col("cut") > block)).isEmpty()
    schema = T.StructType(key_fields(table, keys) + _model_fields())
    short = pack_blocks(train_rows(series).where(F.col("cut") <= block), keys, block=block, carry=["cut"])

    def fit(rows: list) -> Iterable[dict]:
        by_order: dict[Order, list] = {}
        for row in rows:
            by_order.setdefault(order_for(len(row.values), orders), []).append(row)
        by_order.pop(None, None)
        for order, alike in by_order.items():
            ys = [np.asarray(row.values, dtype=float) for row in alike]
            for row, y, (params, sse, last) in zip(alike, ys, search(order, ys)):
                tail = y[-order.margin :]
                yield {**key_values(row, keys), "cut": row.cut, "n": row.n, "params": params, "sse": sse, "tail": tail, "errors": last}

    fitted = map_block_groups(short, fit, schema, ABREAST)
    return fitted.unionByName(_fit_long(series, keys, orders[0], block, schema)) if long_series else fitted


def _fit_long(series: DataFrame, keys: list[str], order: Order, block: int, schema: T.StructType) -> DataFrame:
    """The search over blocks. Blocks and the small per-round result are written, not recomputed."""
    spark = series.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_dir(spark, "checkpoint"))
    long = train_rows(series).where(F.col("cut") > block)
    blocks = (
        pack_blocks(long, keys, before=order.margin, block=block, carry=["cut"])
        .withColumn("more", F.col("blk") < last_block("cut", block))
        .checkpoint()
    )
    found = blocks.where(F.col("blk") == 0).select(*keys, F.array_repeat(F.lit(0.0), order.dims).cast(DOUBLES).alias("center"))
    for turn in range(ROUNDS):
        tried = attach(blocks, found, keys, ["center"])
        every = lambda row, turn=turn: candidates(np.asarray(row.center, dtype=float), turn)
        scored = _score_blocks(tried, keys, order, block, every, CANDIDATES)
        best = scored.groupBy(*keys, "place").agg(F.sum("sse").alias("sse")).groupBy(*keys).agg(F.min_by("place", F.struct("sse", "place")).alias("place"))
        picked = attach(found, best, keys, ["place"])

        def move(row, turn=turn) -> Iterable[dict]:
            yield {**key_values(row, keys), "center": candidates(np.asarray(row.center, dtype=float), turn)[row.place]}

        found = map_blocks(picked, move, found.schema).checkpoint()
    last = _score_blocks(attach(blocks, found, keys, ["center"]), keys, order, block, lambda row: np.asarray([row.center], dtype=float), 1)
    return last.groupBy(*keys).agg(
        F.first("cut").alias("cut"),
        F.first("n").alias("n"),
        F.first("center").alias("params"),
        F.sum("sse").alias("sse"),
        F.max_by("tail", "blk").alias("tail"),
        F.max_by("errors", "blk").alias("errors"),
    ).select(*schema.fieldNames())


def _score_blocks(tried: DataFrame, keys: list[str], order: Order, block: int, sets_of, count: int) -> DataFrame:
    """Sum of squares per block and candidate; the last block also has the tail for a forecast."""
    own = lambda row: int(row.blk) * block

    def end(row) -> np.ndarray:
        sets = sets_of(row)
        return run_errors(order, [np.asarray(row.values, dtype=float)], int(row.at), own(row), sets[None], np.zeros((1, count, order.memory)))[1][0]

    starts = block_starts(tried, keys, end, lambda row: _carry_over(order, sets_of(row), block), carry=["center"])
    schema = T.StructType(
        key_fields(tried, keys)
        + [T.StructField("blk", T.LongType()), T.StructField("place", T.IntegerType()), T.StructField("sse", T.DoubleType())]
        + [T.StructField("cut", T.LongType()), T.StructField("n", T.LongType())]
        + [T.StructField(c, DOUBLES) for c in ("center", "tail", "errors")]
    )
    margin = order.margin

    def score(row) -> Iterable[dict]:
        y = np.asarray(row.values, dtype=float)
        given = state_of(row, count)
        start = np.zeros((count, order.memory)) if given is None else given
        sse, ends = (v[0] for v in run_errors(order, [y], int(row.at), own(row), sets_of(row)[None], start[None]))
        final = not row.more
        base = {**key_values(row, keys), "blk": row.blk, "cut": row.cut, "n": row.n, "center": row.center}
        for p in range(count):
            # Tail and errors are needed once, when a single set is left.
            keep = final and count == 1
            yield {**base, "place": p, "sse": sse[p], "tail": y[-margin:] if keep else None, "errors": ends[p] if keep else None}

    return map_blocks(with_starts(tried, starts, keys), score, schema)


def forecast_sarima(model: DataFrame, keys: Sequence[str] = (), orders: Sequence[Order] = default_orders(24)) -> DataFrame:
    """``keys, idx, pred, aic, bic`` from the cut to the end of each series.

    The recursion of the differenced values runs with future errors 0 and both
    differences are undone along the way; rows leave in pieces.
    """
    keys = list(keys)
    schema = T.StructType(
        key_fields(model, keys) + [T.StructField("at", T.LongType()), T.StructField("preds", DOUBLES)] + [T.StructField(c, T.DoubleType()) for c in ("aic", "bic")]
    )

    def ahead(row) -> Iterable[dict]:
        cut, n = int(row.cut), int(row.n)
        order = order_for(cut, orders)
        a, m = (c[0] for c in order.coefficients(np.asarray([row.params], dtype=float)))
        nobs = cut - order.lost - order.memory
        aic, bic = information(float(row.sse), nobs, order.dims + 1)
        depth, undo = order.memory, order.undo
        y = [float(v) for v in row.tail]
        w = [float(v) for v in order.difference(np.asarray(y))]
        w = [0.0] * max(depth - len(w), 0) + w
        e = [float(v) for v in row.errors]
        base = {**key_values(row, keys), "aic": aic, "bic": bic}
        at, preds = cut, []
        for idx in range(cut, n):
            step = sum(a[j] * w[-lag] for j, lag in enumerate(order.ar_lags)) + sum(m[j] * e[-lag] for j, lag in enumerate(order.ma_lags))
            level = step + sum(c * y[-lag] for lag, c in undo.items())
            w.append(step)
            e.append(0.0)
            y.append(level)
            w, e, y = w[-depth:], e[-depth:], y[-max(order.lost, 1) :]
            preds.append(level)
            if len(preds) == AHEAD_PIECE or idx == n - 1:
                yield {**base, "at": at, "preds": preds}
                at, preds = idx + 1, []

    # Pieces leave Python as arrays; the rows are made on Spark's side.
    pieces = map_blocks(model, ahead, schema).select(*keys, "at", "aic", "bic", F.posexplode("preds").alias("place", "pred"))
    return pieces.select(*keys, (F.col("at") + F.col("place")).alias("idx"), "pred", "aic", "bic")


def information(sse: float, nobs: int, params: int) -> tuple[float | None, float | None]:
    """AIC and BIC of the conditional Gaussian likelihood; None for a perfect fit or no rows."""
    if nobs <= 0 or sse <= 0:
        return None, None
    fit = nobs * (math.log(2 * math.pi) + math.log(sse / nobs) + 1)
    return fit + 2 * params, fit + math.log(nobs) * params


def sarima(
    table: DataFrame,
    keys: Sequence[str] = (),
    period: int = 24,
    block: int = SEARCH_BLOCK,
    long_series: bool | None = None,
    order: Sequence[int] | None = None,
    seasonal_order: Sequence[int] | None = None,
    value: str = "y",
) -> DataFrame:
    """Fit on ``idx < cut``; the rest of the rows with ``pred, aic, bic``, NULL for keys too short to fit.

    ``order`` and ``seasonal_order`` state the model as ``(p, d, q)`` and ``(P, D, Q, period)``.
    """
    table = with_target(table, value)
    orders = orders_of(order, seasonal_order, period)
    ahead = forecast_sarima(fit_sarima(table, keys, orders, block, long_series), keys, orders)
    return table.where(F.col("idx") >= F.col("cut")).join(ahead, [*keys, "idx"], "left")
