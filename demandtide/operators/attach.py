"""Bring per-key statistics to the rows of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach(df: DataFrame, stats: DataFrame, keys: Sequence[str], columns: Sequence[str], how: str = "inner") -> DataFrame:
    """Add ``columns`` of ``stats`` (one row per key) to ``df``.

    With keys this is an equi join whose physical form Spark picks from the measured
    size of ``stats``; without keys there is one row, taken as a scalar subquery.
    """
    if keys:
        return df.join(stats.select(*keys, *columns), list(keys), how)
    one = stats.agg(*[F.first(c).alias(c) for c in columns]).select(F.struct(*columns).alias("s")).scalar()
    wide = df.withColumn("_s", one)
    return wide.select(*df.columns, *[F.col(f"_s.{c}").alias(c) for c in columns])
