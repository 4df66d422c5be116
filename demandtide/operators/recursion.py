"""Linear recursions along time, run block by block.

Exponential smoothing and moving-average errors are recursions ``x' = A x + g(y)``. Over
a whole block that is again ``x_end = M x_start + c``: M is the same for all full blocks
of one parameter set and c needs only the block's own rows. So the blocks of a series run
side by side: one pass gives every c, a walk over one small row per block gives every
start state, and a second pass runs each block from its true start. The result is the
recursion over the whole series, without any task ever holding that series.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandtide.operators.numeric import DOUBLES, key_fields, key_values, map_blocks


def block_starts(
    blocks: DataFrame,
    keys: Sequence[str],
    block_end: Callable[[Any], np.ndarray],
    step: Callable[[Any], np.ndarray],
    carry: Sequence[str] = (),
) -> DataFrame:
    """``keys, blk, start``: the flat start state of every block but the first of a series.

    ``block_end(block)`` gives the end state of a full block: from the true start for
    block 0, from a zero state for the others. It has the shape (parameter sets, state).
    ``step(row)`` gives the matching transition over a full block, (sets, state, state).
    ``carry`` names columns (constant per key) that ``step`` needs. ``blocks`` has
    ``more``, true where another block follows.
    """
    keys = list(keys)
    end_schema = T.StructType(
        key_fields(blocks, keys) + [T.StructField("blk", T.LongType()), T.StructField("end", DOUBLES)] + [blocks.schema[c] for c in carry]
    )

    def ends(row) -> Iterable[dict]:
        yield {**key_values(row, keys), "blk": row.blk, "end": block_end(row).ravel(), **{c: getattr(row, c) for c in carry}}

    parts = map_blocks(blocks.where("more"), ends, end_schema)
    out_schema = T.StructType(key_fields(blocks, keys) + [T.StructField("blk", T.LongType()), T.StructField("start", DOUBLES)])

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("blk").reset_index(drop=True)
        across = step(pdf.iloc[0])
        state, starts = None, []
        for end in pdf["end"]:
            own = np.asarray(end, dtype=float).reshape(across.shape[:2])
            state = own if state is None else np.einsum("pij,pj->pi", across, state) + own
            starts.append(state.ravel())
        return pdf[keys].assign(blk=pdf["blk"] + 1, start=starts)

    return parts.groupBy(*keys).applyInPandas(walk, out_schema)


def with_starts(blocks: DataFrame, starts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Blocks with their start state; NULL for the first of a series."""
    return blocks.join(starts, [*keys, "blk"], "left")


def last_block(cut: str, block: int):
    """Number of the block that holds the last row before ``cut``."""
    return F.floor((F.col(cut) - 1) / block)


def state_of(row: Any, sets: int) -> np.ndarray | None:
    return None if row.start is None else np.asarray(row.start, dtype=float).reshape(sets, -1)
