"""Run numpy code on packed blocks: one row in, some rows out, inside Spark tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from types import SimpleNamespace
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Output handed back to Spark at once: rows, and numbers in their arrays.
OUT_ROWS = 2000
OUT_NUMBERS = 1_000_000


def map_blocks(blocks: DataFrame, func: Callable[[Any], Iterable[dict]], schema: T.StructType) -> DataFrame:
    """Call ``func(row)`` for every row; each call yields output rows as dicts.

    Rows are independent, so Spark is free to spread them. Output leaves in pieces.
    """
    return map_block_groups(blocks, lambda rows: func(rows[0]), schema, 1)


def map_block_groups(blocks: DataFrame, func: Callable[[list], Iterable[dict]], schema: T.StructType, size: int) -> DataFrame:
    """Like ``map_blocks`` with up to ``size`` rows per call, for code that runs many series abreast."""
    names = schema.fieldNames()
    arrays = [f.name for f in schema.fields if isinstance(f.dataType, T.ArrayType)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[dict] = []
        numbers = 0
        for pdf in batches:
            # By position: a key's name need not be a Python name.
            rows = [SimpleNamespace(**dict(zip(pdf.columns, r))) for r in pdf.itertuples(index=False, name=None)]
            for lo in range(0, len(rows), size):
                for made in func(rows[lo : lo + size]):
                    out.append(made)
                    numbers += sum(len(made[a]) for a in arrays if made[a] is not None)
                    if len(out) >= OUT_ROWS or numbers >= OUT_NUMBERS:
                        yield pd.DataFrame(out, columns=names)
                        out, numbers = [], 0
        if out:
            yield pd.DataFrame(out, columns=names)

    return blocks.mapInPandas(run, schema)


def key_fields(df: DataFrame, keys: Iterable[str]) -> list[T.StructField]:
    return [df.schema[k] for k in keys]


def key_values(row: Any, keys: Iterable[str]) -> dict:
    return {k: getattr(row, k) for k in keys}


DOUBLES = T.ArrayType(T.DoubleType())
