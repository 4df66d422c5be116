"""Hourly counts of an unbounded event log: a tumbling window with a watermark.

Only hours that can receive no more events are given out, once each, so the state holds
the open hours and nothing else. Empty hours are not filled here; ``gapless`` does that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandtide.functions.calendar import bucket_number, bucket_start


def _as_instant(ts: Column) -> Column:
    """Wall-clock time as the instant with the same UTC reading, whatever the session's zone."""
    micros = (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")
    return F.timestamp_micros(bucket_number(ts, "minute") * 60_000_000 + micros)


def hours_of(events: DataFrame, ts_col: str = "ts", keys: Sequence[str] = (), delay: str = "1 hour") -> DataFrame:
    """``window, keys, trip_count`` for windows that the watermark has closed. Rows without time or key drop out."""
    named = events.select(*keys, F.col(ts_col).cast("timestamp_ntz").alias("ts")).dropna()
    dated = named.select(*keys, _as_instant(F.col("ts")).alias("at")).withWatermark("at", delay)
    return dated.groupBy(F.window("at", "1 hour"), *keys).agg(F.count("*").alias("trip_count"))


def closed_hours(events: DataFrame, ts_col: str = "ts", keys: Sequence[str] = (), delay: str = "1 hour") -> DataFrame:
    """``keys, ts, trip_count`` for hours older than the latest event minus ``delay``.

    A watermark needs an instant; wall-clock times are read as UTC and given back as they were. An
    instant is taken by the session's wall clock first, as in batch. Rows without time or key drop out.
    """
    start = bucket_start(F.floor(F.unix_seconds("window.start") / 3600).cast("bigint"), "hour")
    return hours_of(events, ts_col, keys, delay).select(*keys, start.alias("ts"), "trip_count")


def run_once(counts: DataFrame, folder: str) -> DataFrame:
    """Take in all that has arrived, append it to ``folder`` and return what is there.

    Progress is kept next to the data: a second call goes on where the first stopped,
    also after a failure.
    """
    query = (
        counts.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", folder + "/progress")
        .trigger(availableNow=True)
        .start(folder + "/counts")
    )
    query.awaitTermination()
    return counts.sparkSession.read.schema(counts.schema).parquet(folder + "/counts")
