"""Least squares per key from sums of products.

Every block turns its rows into one small matrix of products; Spark adds the matrices
with partial aggregation; one solve per key follows. The data is read once, a key with
very many rows is only more blocks, and what is shuffled does not grow with the rows
of a block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from typing import Any

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from demandtide.operators.numeric import DOUBLES, key_fields, key_values, map_blocks


def gram(
    blocks: DataFrame,
    keys: Sequence[str],
    design: Callable[[Any], tuple[np.ndarray, np.ndarray] | None],
    keep: Sequence[str] = (),
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """``keys, size, products`` (+ ``carry`` aggregates over ``keep``) with products = [X y]'[X y], flat.

    ``design(block)`` gives X and y of one packed block, or None.
    """
    keys = list(keys)
    carry = carry or {}
    names = [*keys, *keep]
    made_fields = [T.StructField("size", T.IntegerType()), T.StructField("products", DOUBLES)]
    schema = T.StructType([blocks.schema[c] for c in names] + made_fields)

    def products(row) -> Iterable[dict]:
        made = design(row)
        if made is None:
            return
        x, y = made
        if len(y) == 0:
            return
        full = np.column_stack([x, y])
        yield {**{c: getattr(row, c) for c in names}, "size": full.shape[1], "products": (full.T @ full).ravel()}

    parts = map_blocks(blocks, products, schema)
    # ``size`` depends on the key alone; grouping by it keeps the vectors of one length.
    return (
        parts.groupBy(*keys, "size")
        .agg(Summarizer.sum(array_to_vector("products")).alias("p"), *[c.alias(n) for n, c in carry.items()])
        .select(*keys, "size", vector_to_array("p").alias("products"), *carry)
    )


def solve(sums: DataFrame, keys: Sequence[str], func: Callable[[np.ndarray, Any], dict | None], fields: list[T.StructField]) -> DataFrame:
    """``func(matrix, row)`` per key, with the summed products as a square matrix. None gives no row."""
    keys = list(keys)
    schema = T.StructType(key_fields(sums, keys) + fields)

    def one(row) -> Iterable[dict]:
        m = np.asarray(row.products, dtype=float).reshape(row.size, row.size)
        made = func(m, row)
        if made is not None:
            yield {**key_values(row, keys), **made}

    return map_blocks(sums, one, schema)


def least_squares(m: np.ndarray, penalty: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Coefficients and residual sum of squares from [X y]'[X y]; ``penalty`` is added to the diagonal."""
    a, b, yy = m[:-1, :-1], m[:-1, -1], m[-1, -1]
    lhs = a + np.diag(penalty) if penalty is not None else a
    beta = np.linalg.solve(lhs, b)
    return beta, float(yy - 2 * beta @ b + beta @ a @ beta)
