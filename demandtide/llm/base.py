"""Helpers the training-data operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandtide.session import scratch_dir

# The letters the contracts fold, and the white space between words.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
SPACE = r"[\x20\x09-\x0D]+"
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def kept(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """``df`` written once under the shared folder and read back: its plan ends here,
    and a lost executor costs a read, not the work before it."""
    path = scratch_dir(df.sparkSession, label)
    writer = df.write.partitionBy(by) if by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_az(text: Column) -> Column:
    """Lower-case A-Z only. Plain ASCII takes the byte-wise way with the same result."""
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def words(text: Column, between: str) -> Column:
    """The words of a text, split at the pattern ``between``; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), between), "")


def column_name(wanted: str, taken: list[str]) -> str:
    """``wanted``, with underscores in front until no column of the input has that name."""
    low = {c.lower() for c in taken}
    while wanted.lower() in low:
        wanted = "_" + wanted
    return wanted


def small(df: DataFrame, rows: int) -> DataFrame:
    """A broadcast hint when the table has at most ``rows`` rows, counted first;
    a larger one is joined by a shuffle, whose skew adaptive execution splits."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
