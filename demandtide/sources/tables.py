"""Event log and series sources and sinks."""

from __future__ import annotations

import time
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SERIES_SCHEMA = T.StructType(
    [T.StructField("timestamp", T.TimestampNTZType()), T.StructField("trip_count", T.LongType())]
)
MANIFEST = T.StructType(
    [T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType()), T.StructField("rows", T.LongType()), T.StructField("at", T.LongType())]
)
NORM_SCHEMA = T.StructType([T.StructField("mean", T.DoubleType()), T.StructField("std", T.DoubleType())])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def write_and_read(df: DataFrame, path: str) -> DataFrame:
    """Write a table that several jobs need and read it back: lineage ends at the files."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def month_range(first: tuple[int, int], last: tuple[int, int]) -> list[tuple[int, int]]:
    """All (year, month) pairs from ``first`` to ``last``, both included."""
    lo, hi = first[0] * 12 + first[1] - 1, last[0] * 12 + last[1] - 1
    return [(m // 12, m % 12 + 1) for m in range(lo, hi + 1)]


def _present(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Those of ``paths`` that exist: one listing per parent folder, on any Hadoop file system."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    listed: dict[str, set[str]] = {}
    for path in paths:
        parent, _, _ = path.rpartition("/")
        if parent not in listed:
            folder = jvm.org.apache.hadoop.fs.Path(parent)
            fs = folder.getFileSystem(conf)
            listed[parent] = {s.getPath().getName() for s in fs.listStatus(folder)} if fs.exists(folder) else set()
    return [p for p in paths if p.rpartition("/")[2] in listed[p.rpartition("/")[0]]]


def read_present(spark: SparkSession, paths: Sequence[str], schema: T.StructType) -> DataFrame:
    """Those of the parquet tables that exist, as one; columns may be missing in some.

    With none of them the result is empty and has ``schema``.
    """
    there = _present(spark, paths)
    if not there:
        return spark.createDataFrame([], schema)
    return spark.read.option("mergeSchema", True).parquet(*there)


def read_months(
    spark: SparkSession, template: str, months: Iterable[tuple[int, int]], schema: T.StructType
) -> DataFrame:
    """Monthly parquet files as one table; absent months are passed over.

    ``template`` has ``{year}`` and ``{month}``, e.g. ``raw/trips_{year}-{month:02d}.parquet``.
    """
    return read_present(spark, [template.format(year=y, month=m) for y, m in months], schema)


def union_months(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames, columns matched by name, missing ones NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def months_of(ts_col: str) -> list:
    return [F.year(ts_col).alias("year"), F.month(ts_col).alias("month")]


def missing_months(source: DataFrame, present: DataFrame, ts_col: str) -> DataFrame:
    """Rows of ``source`` whose (year, month) is not among those of ``present``."""
    return source.select("*", *months_of(ts_col)).join(present.select("year", "month").distinct(), ["year", "month"], "left_anti")


def _manifest(target: str) -> str:
    """The folder of the manifest: beside the months, so that reading them does not meet it."""
    return target.rstrip("/") + "-manifest"


def _entries(spark: SparkSession, target: str) -> DataFrame:
    path = _manifest(target)
    return spark.read.schema(MANIFEST).parquet(path) if _present(spark, [path]) else spark.createDataFrame([], MANIFEST)


def complete_months(spark: SparkSession, target: str) -> DataFrame:
    """``year, month, rows`` of the months whose last entry in the manifest says that they are whole."""
    last = _entries(spark, target).groupBy("year", "month").agg(F.max_by("rows", "at").alias("rows"))
    return last.where(F.col("rows") >= 0)


def read_complete_months(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """The rows of whole months; half-written ones are passed over. ``schema`` has ``year`` and ``month`` last."""
    rows = spark.read.schema(schema).parquet(target)
    return rows.join(F.broadcast(complete_months(spark, target).select("year", "month")), ["year", "month"], "left_semi").select(*schema.fieldNames())


def _note(months: DataFrame, target: str) -> None:
    """Add entries ``year, month, rows`` to the manifest; rows -1 says that a month is being written."""
    at = F.lit(time.time_ns())
    months.select("year", "month", F.col("rows").cast("bigint").alias("rows"), at.alias("at")).coalesce(1).write.mode("append").parquet(_manifest(target))


def _write_whole(parts: DataFrame, target: str) -> None:
    """Write month folders between two entries: a failure on the way leaves the months open, and the next
    run writes them again. The counts come from what was written."""
    spark = parts.sparkSession
    wanted = [(r["year"], r["month"]) for r in parts.select("year", "month").distinct().collect()]
    if not wanted:
        return
    months = spark.createDataFrame(wanted, "year int, month int")
    _note(months.withColumn("rows", F.lit(-1)), target)
    parts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").parquet(target)
    there = spark.read.schema(parts.schema).parquet(target).join(F.broadcast(months), ["year", "month"], "left_semi")
    _note(there.groupBy("year", "month").agg(F.count("*").alias("rows")), target)


def ingest_months(source: DataFrame, target: str, ts_col: str) -> None:
    """Add the months ``target`` lacks, one folder per month; whole months already there stay untouched.

    A month counts as there when the manifest says it is whole. One that a failed run left half
    written, or that some other tool put there, is written again and replaced.
    """
    new = missing_months(source, complete_months(source.sparkSession, target), ts_col)
    _write_whole(new.select(*source.columns, "year", "month"), target)


def write_months(df: DataFrame, target: str, ts_col: str) -> None:
    """Write month folders; months in ``df`` replace their old content, others stay."""
    _write_whole(df.select("*", *months_of(ts_col)), target)


def read_events_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV event log with a declared schema."""
    return spark.read.schema(schema).option("header", True).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_series_csv(spark: SparkSession, path: str, schema: T.StructType = SERIES_SCHEMA, timestamp_format: str | None = None) -> DataFrame:
    """CSV series with a ``timestamp`` column."""
    reader = spark.read.schema(schema).option("header", True)
    if timestamp_format:
        reader = reader.option("timestampNTZFormat", timestamp_format)
    return reader.csv(path)


def write_processed(features: DataFrame, path: str) -> None:
    """The feature table, one folder per split: read all of it, or prune to one."""
    features.write.mode("overwrite").partitionBy("split").parquet(path)


def write_norm_params(params: DataFrame, path: str) -> None:
    params.write.mode("overwrite").json(path)


def read_norm_params(spark: SparkSession, path: str, keys: Sequence[str] | T.StructType = ()) -> DataFrame:
    """``keys`` as fields keep their types; bare names are read as text."""
    fields = keys.fields if isinstance(keys, T.StructType) else [T.StructField(k, T.StringType()) for k in keys]
    schema = T.StructType(fields + NORM_SCHEMA.fields)
    return spark.read.schema(schema).json(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """A small report: one row per key and model."""
    write_csv(metrics, path)
