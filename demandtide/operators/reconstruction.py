"""Reconstruction error of windows: how badly a few main patterns describe them."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandtide.operators.attach import attach
from demandtide.operators.features import norm_params, normalize, with_target
from demandtide.operators.gram import gram, solve
from demandtide.operators.numeric import DOUBLES
from demandtide.operators.series import BLOCK
from demandtide.operators.windows import pack_blocks, unpack_blocks


def _windows(values, length: int) -> np.ndarray:
    return np.lib.stride_tricks.sliding_window_view(np.asarray(values, dtype=float), length)


def fit_patterns(blocks: DataFrame, keys: Sequence[str] = (), length: int = 24, patterns: int = 8) -> DataFrame:
    """``keys, center, basis``: mean window and main axes, flat, from one pass over packed blocks."""
    size = min(patterns, length)

    def design(row):
        if len(row.values) < length:
            return None
        x = _windows(row.values, length)
        return x, np.ones(len(x))

    def axes(m: np.ndarray, row) -> dict:
        count = m[-1, -1]
        center = m[:-1, -1] / count
        spread = m[:-1, :-1] / count - np.outer(center, center)
        _, vectors = np.linalg.eigh(spread)
        return {"center": center, "basis": vectors[:, ::-1][:, :size].ravel()}

    fields = [T.StructField("center", DOUBLES), T.StructField("basis", DOUBLES)]
    return solve(gram(blocks.select(*keys, "values"), keys, design), keys, axes, fields)


def pattern_scores(
    series: DataFrame, keys: Sequence[str] = (), length: int = 24, patterns: int = 8, method: str = "patterns", block: int = BLOCK, value: str = "y"
) -> DataFrame:
    """Score table: mean squared distance of each normalized window from its projection.

    The windows are never spread out as rows: blocks of the series go in, one score per
    row comes out.
    """
    keys = list(keys)
    series = with_target(series, value)
    z = normalize(series, norm_params(series, keys), keys).withColumn("z", F.coalesce("z", F.lit(0.0)))
    along = ["ts", "y"]
    blocks = pack_blocks(z, keys, "z", before=length - 1, block=block, along=along)
    fitted = attach(blocks, fit_patterns(blocks, keys, length, patterns), keys, ["center", "basis"], "left")

    @F.pandas_udf(DOUBLES)
    def score(values: pd.Series, center: pd.Series, basis: pd.Series) -> pd.Series:
        made = []
        for v, c, b in zip(values, center, basis):
            out = np.zeros(len(v))
            if c is not None and len(v) >= length:
                x = _windows(v, length) - c
                b = np.asarray(b).reshape(length, -1)
                rest = x - (x @ b) @ b.T
                out[length - 1 :] = (rest * rest).mean(axis=1)
            made.append(out)
        return pd.Series(made)

    scored = fitted.withColumn("made", score("values", "center", "basis"))
    return unpack_blocks(scored, keys, along, F.col("made"), "score", block).select(
        *keys, F.lit(method).alias("method"), "ts", "idx", "n", "y", "score"
    )
