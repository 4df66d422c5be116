"""Gap-free hourly series of an unbounded event log, with the trailing mean of each hour.

Two stateful steps. The first counts hours natively, with partial sums before its shuffle, and hands
an hour on when the watermark has closed it: a key with a third of all events is still one row an
hour. The second keeps, per key, the next hour to give out and the last ``window`` counts. Counts
that arrive fill the hours before them with zeros; a timer on the next open hour gives out empty
hours of keys to which nothing happens.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from demandtide.functions.calendar import bucket_start
from demandtide.streaming.hourly import hours_of, run_once

HOUR_MS = 3_600_000
#: The state store that holds timers.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Filler(StatefulProcessor):
    """Hours of one key in order; every hour once."""

    def __init__(self, keys: list[str], window: int):
        self.keys, self.window = keys, window

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", T.StructType([T.StructField("next", T.LongType()), T.StructField("tail", T.ArrayType(T.LongType()))]))

    def _until(self, key: tuple, next_hour: int, tail: list, end: int, counts: dict[int, int]) -> Iterator[Row]:
        """Hours from ``next_hour`` up to, not including, ``end``; the state and the timer behind them."""
        while next_hour < end:
            c = counts.get(next_hour, 0)
            mean = sum(tail) / len(tail) if tail else None
            yield Row(**dict(zip(self.keys, key)), hour=next_hour, y=float(c), pred=mean)
            tail = [*tail, c][-self.window :]
            next_hour += 1
        self.state.update((next_hour, tail))
        # The watermark closes the hour when it reaches the hour's end.
        self.handle.registerTimer((next_hour + 1) * HOUR_MS)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        counts = {r["hour"]: r["trip_count"] for r in rows}
        next_hour, tail = self.state.get() if self.state.exists() else (min(counts), [])
        if self.state.exists():
            self.handle.deleteTimer((next_hour + 1) * HOUR_MS)
        end = max(max(counts) + 1, timerValues.getCurrentWatermarkInMs() // HOUR_MS)
        yield from self._until(key, next_hour, list(tail), end, counts)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        next_hour, tail = self.state.get()
        yield from self._until(key, next_hour, list(tail), timerValues.getCurrentWatermarkInMs() // HOUR_MS, {})

    def close(self) -> None:
        pass


def gapless_hours(events: DataFrame, ts_col: str = "ts", keys: Sequence[str] = (), delay: str = "1 hour", window: int = 24) -> DataFrame:
    """``keys, ts, y, pred`` for every hour from a key's first event to the watermark.

    ``pred`` is the mean of the ``window`` hours before, or of as many as there are, NULL for the first.
    Needs the state store of ``timers_on`` when the query starts. Rows without time or key drop out.
    """
    keys = list(keys)
    counts = hours_of(events, ts_col, keys, delay).select(
        *(keys or [F.lit("all").alias("series")]), F.floor(F.unix_seconds("window.start") / 3600).cast("bigint").alias("hour"), F.window_time("window").alias("at"), "trip_count"
    )
    by = keys or ["series"]
    schema = T.StructType([*[counts.schema[k] for k in by], T.StructField("hour", T.LongType()), T.StructField("y", T.DoubleType()), T.StructField("pred", T.DoubleType())])
    filled = counts.groupBy(*by).transformWithState(_Filler(by, window), schema, "append", "EventTime")
    return filled.select(*keys, bucket_start(F.col("hour"), "hour").alias("ts"), "y", "pred")


@contextmanager
def timers_on(spark: SparkSession):
    """The session's state store is one with timers while queries are started."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, STORE)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def run_gapless(events: DataFrame, folder: str, ts_col: str = "ts", keys: Sequence[str] = (), delay: str = "1 hour", window: int = 24) -> DataFrame:
    """Take in all that has arrived and return every closed hour so far (see ``run_once``)."""
    with timers_on(events.sparkSession):
        return run_once(gapless_hours(events, ts_col, keys, delay, window), folder)
