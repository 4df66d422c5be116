"""Classical additive decomposition: centred moving average, phase means, rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandtide.operators.prefix import long_centered_trend
from demandtide.operators.series import BLOCK
from demandtide.operators.windows import over_time


def centered_trend(series: DataFrame, keys: Sequence[str] = (), period: int = 24, block: int = BLOCK) -> DataFrame:
    """Add ``trend``: the mean of one period around each row, NULL near both ends.

    An even period has no middle row, so the two outermost rows count half. Periods beyond two
    blocks are taken from prefix sums.
    """
    half = period // 2
    if half > block:
        return long_centered_trend(series, keys, period, block)

    def build(w):
        total = F.sum("y").over(w.rowsBetween(-half, half))
        if period % 2 == 0:
            total = total - (F.lag("y", half).over(w) + F.lead("y", half).over(w)) / 2
        complete = (F.col("idx") >= half) & (F.col("idx") < F.col("n") - half)
        return {"trend": F.when(complete, total / period)}

    return over_time(series, keys, build, before=half, after=half, block=block)


def decompose(series: DataFrame, keys: Sequence[str] = (), period: int = 24, block: int = BLOCK) -> DataFrame:
    """``observed = trend + seasonal + resid``. Series shorter than two periods give no rows.

    Phase 0 is the first row of the series, not a clock hour.
    """
    keys = list(keys)
    long_enough = series.where(F.col("n") >= 2 * period)
    rows = centered_trend(long_enough, keys, period, block).withColumn("phase", F.col("idx") % period)
    # ``period`` rows per key: the window that centres them is small for any series.
    whole = Window.partitionBy(*keys)
    # The first timestamp keeps ``ts`` in this branch, so the shuffle of the rows serves both.
    pattern = (
        rows.groupBy(*keys, "phase")
        .agg(F.avg(F.col("y") - F.col("trend")).alias("p"), F.min("ts").alias("first_ts"))
        .where(F.col("first_ts").isNotNull())
        .select(*keys, "phase", (F.col("p") - F.avg("p").over(whole)).alias("seasonal"))
    )
    return rows.join(pattern, [*keys, "phase"]).select(
        *keys,
        "ts",
        "idx",
        "n",
        F.col("y").alias("observed"),
        "trend",
        "seasonal",
        (F.col("y") - F.col("trend") - F.col("seasonal")).alias("resid"),
    )
