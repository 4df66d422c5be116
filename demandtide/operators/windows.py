"""Windows along time, cut into blocks with a margin so that no series sits in one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from demandtide.operators.prefix import long_trailing_mean
from demandtide.operators.series import BLOCK


def with_margin(series: DataFrame, keys: Sequence[str], before: int | Column, after: int = 0, block: int = BLOCK) -> DataFrame:
    """Copy each row into every block that needs it; ``_blk`` says which.

    Block k owns ``idx`` in ``[k*block, (k+1)*block)`` and also receives ``before``
    rows on its left and ``after`` on its right. The copies add ``(before+after)/block``.
    ``before`` may depend on the series; a margin may reach over several blocks.
    """
    if isinstance(before, int) and max(before, after) > block:
        raise ValueError("the margin must fit in one block")
    lo = F.floor(F.greatest(F.col("idx") - after, F.lit(0)) / block)
    hi = F.floor(F.least(F.col("idx") + before, F.col("n") - 1) / block)
    return series.withColumn("_blk", F.explode(F.sequence(lo, hi)))


def owned(block: int = BLOCK) -> Column:
    """True for the rows a block owns, false for its margin copies."""
    return F.floor(F.col("idx") / block) == F.col("_blk")


def over_time(
    series: DataFrame,
    keys: Sequence[str],
    columns: Callable[[WindowSpec], dict[str, Column]],
    before: int,
    after: int = 0,
    block: int = BLOCK,
) -> DataFrame:
    """Add window columns that look ``before`` rows back and ``after`` rows ahead.

    ``columns`` gets the window (key and block, ordered by ``idx``) and returns the new
    columns. Equal to the same window over the whole series.
    """
    w = Window.partitionBy(*keys, "_blk").orderBy("idx")
    cut = with_margin(series, keys, before, after, block)
    new = columns(w)
    out = cut.select("*", *[c.alias(name) for name, c in new.items()])
    return out.where(owned(block)).drop("_blk")


def trailing_mean(series: DataFrame, keys: Sequence[str] = (), window: int = 24, name: str = "pred", block: int = BLOCK) -> DataFrame:
    """Mean of the ``window`` values before each row, or of as many as there are. A window beyond a block
    is taken from prefix sums."""
    if window > block:
        return long_trailing_mean(series, keys, window, name, block)
    return over_time(series, keys, lambda w: {name: F.avg("y").over(w.rowsBetween(-window, -1))}, before=window, block=block)


def lagged(series: DataFrame, keys: Sequence[str] = (), lag: int = 24, name: str = "pred", block: int = BLOCK) -> DataFrame:
    """Value ``lag`` rows earlier."""
    return over_time(series, keys, lambda w: {name: F.lag("y", lag).over(w)}, before=lag, block=block)


def supervised_windows(
    series: DataFrame, keys: Sequence[str] = (), length: int = 24, value: str = "y", split: str | None = "split", block: int = BLOCK
) -> DataFrame:
    """Pairs of the ``length`` values before a row (``x``, oldest first) and its value.

    With ``split`` the window never crosses from one split into the next, so the first
    ``length`` rows of each split have no pair.
    """
    part = [split] if split else []

    def build(w: WindowSpec) -> dict[str, Column]:
        back = Window.partitionBy(*keys, "_blk", *part).orderBy("idx").rowsBetween(-length, -1)
        return {"x": F.collect_list(value).over(back)}

    return over_time(series, keys, build, before=length, block=block).where(F.size("x") == length)


def reconstruction_windows(series: DataFrame, keys: Sequence[str] = (), length: int = 24, value: str = "y", block: int = BLOCK) -> DataFrame:
    """Every run of ``length`` values (``x``, oldest first), kept at its last row."""
    return over_time(
        series, keys, lambda w: {"x": F.collect_list(value).over(w.rowsBetween(-(length - 1), 0))}, before=length - 1, block=block
    ).where(F.col("idx") >= length - 1)


def differences(series: DataFrame, keys: Sequence[str] = (), lags: int = 0, block: int = BLOCK) -> DataFrame:
    """Columns ``y_lag``, ``dy`` and ``dy_lag1 .. dy_lagN`` of the unit-root regression."""

    def build(w: WindowSpec) -> dict[str, Column]:
        cols = {"y_lag": F.lag("y").over(w), "dy": F.col("y") - F.lag("y").over(w)}
        for k in range(1, lags + 1):
            cols[f"dy_lag{k}"] = F.lag("y", k).over(w) - F.lag("y", k + 1).over(w)
        return cols

    return over_time(series, keys, build, before=lags + 1, block=block).where(F.col("idx") > lags)


def last_rows(series: DataFrame, count: int) -> DataFrame:
    """The last ``count`` rows of each series; a filter, no sort."""
    return series.where(F.col("idx") >= F.col("n") - count)


def head_rows(series: DataFrame, count: int = 5) -> DataFrame:
    """Preview of the first rows in time."""
    return series.orderBy("ts").limit(count)


def partitions(df: DataFrame) -> int:
    """As many partitions as the session's shuffles have, and no fewer than there are cores."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def pack_blocks(
    series: DataFrame,
    keys: Sequence[str] = (),
    value: str = "y",
    before: int | Column = 0,
    block: int = BLOCK,
    carry: Sequence[str] = (),
    along: Sequence[str] = (),
) -> DataFrame:
    """One row per key and block: ``keys, blk, at, n, values`` (+ ``carry`` columns, one value each).

    ``values`` starts ``before`` rows ahead of the block (fewer at the series start) and
    ``at`` is the ``idx`` of its first element. An array never exceeds ``block + before``.
    ``along`` keeps more columns of every row, in ``rows`` (see ``unpack_blocks``).
    """
    cut = with_margin(series, keys, before, 0, block)
    # Blocks are small in bytes but costly to work on. A stated number of partitions keeps
    # adaptive execution from putting them all into a few tasks.
    packed = cut.repartition(partitions(series), *keys, "_blk").groupBy(*keys, "_blk").agg(
        F.sort_array(F.collect_list(F.struct("idx", F.col(value).alias("v"), *along))).alias("rows"),
        F.first("n").alias("n"),
        *[F.first(c).alias(c) for c in carry],
    )
    kept = ["rows"] if along else []
    return packed.select(
        *keys, F.col("_blk").alias("blk"), F.col("rows")[0]["idx"].alias("at"), "n", F.col("rows.v").alias("values"), *carry, *kept
    )


def unpack_blocks(blocks: DataFrame, keys: Sequence[str], along: Sequence[str], result: Column, name: str, block: int = BLOCK) -> DataFrame:
    """Back to rows: ``keys, idx, n``, the ``along`` columns and one number of ``result`` per row.

    ``result`` is an array next to ``values``; the margin rows of a block are left out.
    No join is needed to bring results of numpy code to their rows.
    """
    spread = blocks.select(*keys, "blk", "n", F.explode(F.arrays_zip("rows", result.alias("made"))).alias("z"))
    row = F.col("z.rows")
    return spread.where(F.floor(row["idx"] / block) == F.col("blk")).select(
        *keys, row["idx"].alias("idx"), "n", *[row[c].alias(c) for c in along], F.col("z.made").alias(name)
    )
