"""Window sums of any length along a series, from prefix sums in pieces.

Each block sums its own rows, one small row per block; a running sum over these rows says what lies
before each block; a running sum within the block finishes the prefix. A window's sum is then the
difference of two prefixes, brought together by one shuffle of the rows that carry them. No task ever
holds more than a block, however long the window. Sums of counts are exact; other values lose what a
difference of two sums loses.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandtide.operators.series import BLOCK


def with_prefix(series: DataFrame, keys: Sequence[str] = (), value: str = "y", block: int = BLOCK) -> DataFrame:
    """Add ``upto``: the sum and the number of values of all rows up to and including this one, as a struct."""
    keys = list(keys)
    rows = series.withColumn("_blk", F.floor(F.col("idx") / block))
    v, one = F.coalesce(F.col(value), F.lit(0.0)), F.col(value).isNotNull().cast("bigint")
    totals = rows.groupBy(*keys, "_blk").agg(F.sum(v).alias("_s"), F.sum(one).alias("_c"))
    # One row per block: a series of a billion rows has a quarter of a million.
    before = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*keys, "_blk", F.coalesce(F.sum("_s").over(before), F.lit(0.0)).alias("_s"), F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_c"))
    own = Window.partitionBy(*keys, "_blk").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.struct((F.col("_s") + F.sum(v).over(own)).alias("s"), (F.col("_c") + F.sum(one).over(own)).alias("c"))
    return rows.join(starts, [*keys, "_blk"]).withColumn("upto", upto).drop("_blk", "_s", "_c")


def bring(rows: DataFrame, keys: Sequence[str], carried: Column, offsets: dict[str, int]) -> DataFrame:
    """Add columns with ``carried`` of the row ``offset`` places ahead (negative: before), NULL where there is none."""
    keys = list(keys)
    names = [c for c in rows.columns if c not in keys and c != "idx"]
    sent = [F.struct(F.col("idx").alias("idx"), F.struct(*names).alias("own"), *[F.lit(None).cast(rows.select(carried.alias("x")).schema["x"].dataType).alias(n) for n in offsets])]
    for name, offset in offsets.items():
        others = [(carried if n == name else F.lit(None).cast(rows.select(carried.alias("x")).schema["x"].dataType)).alias(n) for n in offsets]
        sent.append(F.struct((F.col("idx") - offset).alias("idx"), F.lit(None).cast(rows.select(F.struct(*names).alias("x")).schema["x"].dataType).alias("own"), *others))
    met = rows.select(*keys, F.explode(F.array(*sent)).alias("m")).select(*keys, "m.*")
    met = met.groupBy(*keys, "idx").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("own", *offsets)]).where(F.col("own").isNotNull())
    return met.select(*keys, "idx", *[F.col("own")[n].alias(n) for n in names], *offsets)


def long_trailing_mean(series: DataFrame, keys: Sequence[str] = (), window: int = 24, name: str = "pred", block: int = BLOCK) -> DataFrame:
    """Mean of the ``window`` values before each row, or of as many as there are."""
    # Sums of the rows before a row: up to the row before it, less up to ``window`` rows before that.
    rows = bring(with_prefix(series, keys, block=block), keys, F.col("upto"), {"_to": -1, "_from": -window - 1})
    part = lambda f: F.col("_to")[f] - F.coalesce(F.col("_from")[f], F.lit(0))
    mean = F.when(part("c") > 0, part("s") / part("c"))
    return rows.select(*series.columns, mean.alias(name))


def long_centered_trend(series: DataFrame, keys: Sequence[str] = (), period: int = 24, block: int = BLOCK) -> DataFrame:
    """Add ``trend``: the mean of one period around each row, the two outermost rows of an even period
    counting half; NULL near both ends."""
    half, even = period // 2, period % 2 == 0
    rows = with_prefix(series, keys, block=block)
    if even:
        # The sum up to a row and up to the row before it: half of the row itself is left out.
        rows = rows.withColumn("upto", F.col("upto")["s"] - F.col("y") / 2)
    else:
        rows = rows.withColumn("upto", F.col("upto")["s"])
    rows = bring(rows, keys, F.col("upto"), {"_to": half, "_from": -half if even else -half - 1})
    complete = (F.col("idx") >= half) & (F.col("idx") < F.col("n") - half)
    return rows.select(*series.columns, F.when(complete, (F.col("_to") - F.coalesce("_from", F.lit(0.0))) / period).alias("trend"))
