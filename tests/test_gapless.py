"""Gap-free hours of a stream against the batch series, in pieces and in another zone."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from demandtide.operators.series import demand_series
from demandtide.operators.windows import trailing_mean
from demandtide.streaming.gapless import run_gapless


def _add(spark, folder, name, rows):
    """One more file of the log; times without a zone."""
    spark.createDataFrame(rows, "t string, k string").select(F.col("t").cast("timestamp_ntz").alias("ts"), "k").coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def _stream(spark, folder):
    schema = spark.read.parquet(f"{folder}/*").schema
    return spark.readStream.schema(schema).parquet(f"{folder}/*")


def _expected(spark, folder, keys, window):
    """The batch series up to the watermark: empty hours behind a key's last event are zeros too."""
    log = spark.read.parquet(f"{folder}/*").dropna(subset=["ts", *keys])
    mark = pd.Timestamp(log.agg(F.max("ts")).first()[0]) - pd.Timedelta("1h")
    end = mark.floor("h")
    # A pseudo event in the watermark's hour stretches every key to it; the hour itself is left out.
    stretched = log.unionByName(log.select(F.lit(str(end)).cast("timestamp_ntz").alias("ts"), "k").distinct())
    series = demand_series(stretched, keys=keys)
    rows = trailing_mean(series, keys, window).where(F.col("ts") < F.lit(str(end)).cast("timestamp_ntz"))
    return sorted((r["k"] if keys else "", r["ts"], r["y"], r["pred"]) for r in rows.collect())


def _got(out, keys):
    return sorted((r["k"] if keys else "", r["ts"], r["y"], r["pred"]) for r in out.collect())


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("keys", [["k"], []])
def test_pieces_of_a_stream_equal_the_batch(spark, tmp_path, zone, keys):
    """A key that stays idle is filled by its timer, one that comes back by its next count."""
    before = spark.conf.get("spark.sql.session.timeZone")
    folder, out = f"{tmp_path}/in", f"{tmp_path}/out"
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        pieces = [
            [("2024-03-09 22:10:00", "a"), ("2024-03-09 22:50:00", "a"), ("2024-03-10 01:05:00", "a"), ("2024-03-09 23:30:00", "b"), (None, "a"), ("2024-03-09 22:00:00", None)],
            [("2024-03-10 09:00:00", "a"), ("2024-03-10 08:59:59", "c")],
            [("2024-03-11 12:30:00", "a"), ("2024-03-11 02:30:00", "c"), ("2024-03-11 12:00:00", "b")],
        ]
        for i, rows in enumerate(pieces):
            _add(spark, folder, f"p{i}", rows)
            got = run_gapless(_stream(spark, folder), out, keys=keys, window=3)
            assert _got(got, keys) == _expected(spark, folder, keys, 3)
        assert got.count() > (70 if keys else 35)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_nothing_closed_gives_nothing(spark, tmp_path):
    _add(spark, f"{tmp_path}/in", "p", [("2024-01-01 00:10:00", "a"), ("2024-01-01 00:50:00", "b")])
    assert run_gapless(_stream(spark, f"{tmp_path}/in"), f"{tmp_path}/out", keys=["k"]).count() == 0
