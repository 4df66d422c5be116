import datetime as dt

import pytest
from pyspark.sql import functions as F

from demandtide.functions.calendar import bucket_number, bucket_start, floor_to_bucket
from demandtide.operators import series as se
from demandtide.sources.tables import table
from tests.conftest import SF, SF_LARGER


def log(spark, stamps, keys=None):
    rows = [(t, k) for t, k in zip(stamps, keys or [None] * len(stamps))]
    return spark.createDataFrame(rows, "ts string, k string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def test_gaps_are_zero_and_positions_count_hours(spark):
    s = se.demand_series(log(spark, ["2024-01-01 05:59", "2024-01-01 05:01", "2024-01-01 09:30"])).orderBy("idx").collect()
    assert [(r.idx, r.n, r.y) for r in s] == [(0, 5, 2.0), (1, 5, 0.0), (2, 5, 0.0), (3, 5, 0.0), (4, 5, 1.0)]
    assert s[0].ts == dt.datetime(2024, 1, 1, 5) and s[-1].ts == dt.datetime(2024, 1, 1, 9)


def test_missing_times_drop_and_duplicates_count(spark):
    s = se.demand_series(log(spark, [None, "2024-01-01 00:10", "2024-01-01 00:10"])).collect()
    assert [(r.idx, r.n, r.y) for r in s] == [(0, 1, 2.0)]


def test_text_times_that_cannot_be_read_drop(spark):
    events = spark.createDataFrame([("2024-01-01 00:10:00",), ("no time",), (None,)], "ts string")
    assert [r.y for r in se.demand_series(events).collect()] == [1.0]


def test_empty_log_gives_no_rows(spark):
    empty = log(spark, ["2024-01-01 00:10"]).where("false")
    assert se.demand_series(empty).count() == 0
    assert se.demand_series(empty, keys=["k"]).count() == 0


@pytest.mark.parametrize("first,last", [("2001-01-01 00:00", "2024-01-01 00:00"), ("1965-03-01 07:00", "1971-01-01 00:00")])
def test_gap_over_many_blocks(spark, first, last):
    """Also before 1970, where bucket numbers are negative."""
    s = se.demand_series(log(spark, [first, last])).agg(
        F.count("*").alias("rows"), F.countDistinct("idx").alias("places"), F.max("idx").alias("last"), F.min("n").alias("n"),
        F.sum("y").alias("events"), F.min("ts").alias("a"), F.max("ts").alias("z"),
    ).collect()[0]
    hours = int((dt.datetime.fromisoformat(last) - dt.datetime.fromisoformat(first)).total_seconds()) // 3600 + 1
    assert (s.rows, s.places, s["last"], s.n, s.events) == (hours, hours, hours - 1, hours, 2.0)
    assert (s.a, s.z) == (dt.datetime.fromisoformat(first), dt.datetime.fromisoformat(last))


def test_bounds_cut_stray_times_and_reach_the_scan(spark):
    events = table(spark, SF, "events")
    kept = se.between(events, "ts", "2024-01-08", "2024-01-15")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-08T00:00)" in plan and "LessThan(ts,2024-01-15T00:00)" in plan


def test_length_guard(spark):
    events = log(spark, ["2001-01-01 00:00", "2024-01-01 00:00"])
    with pytest.raises(Exception, match="series longer than 1000"):
        se.demand_series(events, max_buckets=1000).collect()
    assert se.demand_series(events, max_buckets=300_000).count() == se.demand_series(events).count()


def test_rows_without_key_drop_and_keys_have_their_own_range(spark):
    events = log(spark, ["2024-01-01 00:00", "2024-01-01 02:00", "2024-01-01 05:00", "2024-01-01 09:00"], ["a", "a", "b", None])
    got = {(r.k, r.idx, r.n, r.y) for r in se.demand_series(events, keys=["k"]).collect()}
    assert got == {("a", 0, 3, 1.0), ("a", 1, 3, 0.0), ("a", 2, 3, 1.0), ("b", 0, 1, 1.0)}
    common = se.demand_series(events, keys=["k"], common_range=True)
    assert common.groupBy("k").agg(F.count("*").alias("c"), F.sum("y").alias("s")).orderBy("k").collect() == [("a", 6, 2.0), ("b", 6, 1.0)]


@pytest.mark.parametrize("bucket", ["minute", "hour", "day"])
def test_bucket_numbers_invert(spark, bucket):
    stamps = ["1969-12-31 23:59:59", "1970-01-01 00:00:00", "2024-02-29 13:37:11", "2100-07-01 00:00:00"]
    df = log(spark, stamps).select("ts", floor_to_bucket(F.col("ts"), bucket).alias("f"), F.date_trunc(bucket, "ts").cast("timestamp_ntz").alias("d"))
    assert all(r.f == r.d for r in df.collect())


def test_wall_clock_hours_do_not_depend_on_the_zone(spark):
    """02:30 does not exist on this day in Berlin, yet a wall-clock log may hold it."""
    events = log(spark, ["2024-03-31 01:30", "2024-03-31 02:30", "2024-03-31 03:30"])
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        got = [(r.ts.hour, r.y) for r in se.demand_series(events).orderBy("idx").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [(1, 1.0), (2, 1.0), (3, 1.0)]


def test_log_is_read_once_and_nothing_is_joined(spark):
    s = se.demand_series(table(spark, SF, "events"), keys=["event_type"])
    s.collect()
    plan = s._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan and "Join" not in plan


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_result_does_not_depend_on_partitioning(spark, partitions):
    events = table(spark, SF, "events")
    plain = {tuple(r) for r in se.demand_series(events, keys=["event_type"]).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert {tuple(r) for r in se.demand_series(events.repartition(5), keys=["event_type"]).collect()} == plain
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_one_hot_key(spark):
    """A third of all events in one key and one hour: counts collapse before any shuffle."""
    events = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit("2024-01-01 00:30")).otherwise(F.lit("2024-01-02 12:30")).cast("timestamp_ntz").alias("ts"),
    )
    s = se.demand_series(events, keys=["k"]).groupBy("k").agg(F.sum("y").alias("y")).cache()
    assert s.where("k = 'hot'").collect()[0].y == 10_000
    assert s.agg(F.sum("y")).collect()[0][0] == 30_000


def test_exact_sample(spark):
    ids = spark.range(1003).withColumnRenamed("id", "event_id")
    got = se.sample_exact(ids, "event_id", 0.1).collect()
    assert len(got) == 100 and len(set(got)) == 100
    whole = sorted(range(1003), key=lambda i: (i * 2654435761 % 2**32, i))
    assert {r.event_id for r in got} == set(whole[:100])
    big = spark.range(2**40, 2**40 + 50).withColumnRenamed("id", "event_id")
    assert {r.event_id for r in se.sample_by_hash(big, "event_id", 0.5).collect()} == {
        i for i in range(2**40, 2**40 + 50) if i * 2654435761 % 2**32 < 2**31
    }


def test_drawn_sample(spark):
    ids = spark.range(10_000)
    drawn = se.sample_rows(ids, 0.1)
    assert 800 < drawn.count() < 1200 and drawn.collect() == se.sample_rows(ids, 0.1).collect()
    assert se.sample_rows(ids, 1.0).count() == 10_000


def test_rescaled_sample(spark):
    s = se.demand_series(log(spark, ["2024-01-01 00:10"]))
    assert se.rescale_sampled(s, 0.1).collect()[0].y == 10.0


def test_golden_counts(spark):
    for sf, zero, std in ((SF, 189, 1.191714), (SF_LARGER, 0, 3.786939)):
        row = se.demand_series(table(spark, sf, "events")).agg(
            F.count("*").alias("n"), F.sum((F.col("y") == 0).cast("int")).alias("zero"), F.round(F.stddev_samp("y"), 6).alias("std")
        ).collect()[0]
        assert tuple(row) == (720, zero, std)


def test_buckets_compose(spark):
    df = spark.range(1).select(bucket_start(bucket_number(F.lit("2024-01-01 10:59").cast("timestamp_ntz"), "hour"), "hour").alias("t"))
    assert df.collect()[0].t == dt.datetime(2024, 1, 1, 10)
