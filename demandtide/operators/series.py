"""Event log to gap-free counts per time bucket and series key."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandtide.functions.calendar import bucket_number, bucket_start, parse_timestamp

# Rows of one series that share a task: 24 weeks of hours. All work along time is
# cut into such pieces, so a single long series still spreads over the cluster.
BLOCK = 4032
# Rows that an exact sample puts in order in one task.
SLICE_ROWS = 100_000
# Names of the series' own columns and of the blocks it is packed in.
RESERVED = frozenset(("ts", "idx", "n", "y", "b", "c", "blk", "at", "values", "rows", "cut", "rank", "first_b", "last_b", "next_b"))


def between(events: DataFrame, ts_col: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Keep ``start <= ts < end``, stated on the raw column so that it reaches the scan.

    Texts are read first; those that are no time drop out.
    """
    ts = F.col(ts_col)
    if events.schema[ts_col].dataType.typeName() not in ("timestamp_ntz", "timestamp", "date"):
        ts = parse_timestamp(ts)
    if start is not None:
        events = events.where(ts >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        events = events.where(ts < F.lit(end).cast("timestamp_ntz"))
    return events


def count_buckets(events: DataFrame, ts_col: str = "ts", keys: Sequence[str] = (), bucket: str = "hour") -> DataFrame:
    """Events per key and bucket, as ``keys, b, c``. Rows without time or key drop out."""
    keys = list(keys)
    ts = F.col(ts_col)
    if events.schema[ts_col].dataType.typeName() not in ("timestamp_ntz", "date"):
        ts = parse_timestamp(ts)
    # Stated one by one, so that the scan gets them and later joins on the keys add nothing.
    for col in (*[F.col(k) for k in keys], ts):
        events = events.where(col.isNotNull())
    return events.select(*keys, bucket_number(ts, bucket).alias("b")).groupBy(*keys, "b").agg(F.count("*").alias("c"))


def bucket_extent(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """First and last bucket per key.

    The event total is not idle: it keeps this branch on the same columns as the
    counts themselves, so Spark runs the one shuffle of the counts for both.
    """
    return (
        counts.groupBy(*keys)
        .agg(F.min("b").alias("first_b"), F.max("b").alias("last_b"), F.sum("c").alias("events"))
        .where(F.col("events") > 0)
    )


def fill_gaps(
    counts: DataFrame,
    keys: Sequence[str] = (),
    bucket: str = "hour",
    common_range: bool = False,
    max_buckets: int | None = None,
) -> DataFrame:
    """Counts to a series: every bucket from the first to the last, zeros where nothing happened.

    There is no join and no shuffle of the filled rows. Each block of ``BLOCK``
    buckets gets one marker row at its start; a row then fills the buckets up to the
    next row of its block. Only present counts and markers are shuffled.

    ``common_range`` gives all keys the range of the whole log. ``max_buckets`` stops
    the job when one stray timestamp would stretch a series beyond it.
    """
    keys = list(keys)
    if clash := {k.lower() for k in keys} & RESERVED:
        raise ValueError(f"rename the key columns {sorted(clash)}: a series has columns of these names")
    block_of = lambda b: F.floor(b / BLOCK)
    extent = bucket_extent(counts, keys)
    if common_range and keys:
        whole = bucket_extent(counts).select(F.struct("first_b", "last_b").alias("r")).scalar()
        extent = extent.select(*keys, whole.alias("r"), "events").select(
            *keys, F.col("r.first_b").alias("first_b"), F.col("r.last_b").alias("last_b"), "events"
        )
    if max_buckets is not None:
        length = F.col("last_b") - F.col("first_b") + 1
        message = F.concat(F.lit(f"series longer than {max_buckets} buckets: "), length.cast("string"))
        extent = extent.withColumn(
            "last_b", F.when(length <= max_buckets, F.col("last_b")).otherwise(F.raise_error(message).cast("bigint"))
        )
    markers = extent.select(
        *keys, "first_b", "last_b", F.explode(F.sequence(block_of(F.col("first_b")), block_of(F.col("last_b")))).alias("blk")
    ).select(
        *keys,
        "blk",
        F.greatest("first_b", F.col("blk") * BLOCK).alias("b"),
        F.lit(0).cast("bigint").alias("c"),
        "first_b",
        "last_b",
        F.lit(0).alias("rank"),
    )
    nothing = F.lit(None).cast("bigint")
    present = counts.select(
        *keys, block_of(F.col("b")).alias("blk"), "b", "c", nothing.alias("first_b"), nothing.alias("last_b"), F.lit(1).alias("rank")
    )
    # A marker comes before a count of the same bucket and then fills nothing.
    w = Window.partitionBy(*keys, "blk").orderBy("b", "rank")
    rows = present.unionByName(markers).select(
        *keys,
        "blk",
        "b",
        "c",
        F.lead("b").over(w).alias("next_b"),
        F.first("first_b", ignorenulls=True).over(w).alias("first_b"),
        F.first("last_b", ignorenulls=True).over(w).alias("last_b"),
    )
    until = F.coalesce("next_b", F.least(F.col("last_b") + 1, (F.col("blk") + 1) * BLOCK))
    # No bucket lies before the first. Saying so keeps ``first_b`` in every plan, also where
    # only values are wanted, so that all uses of a series share one shuffle.
    fills = (until > F.col("b")) & (F.col("b") >= F.col("first_b"))
    filled = rows.select(*keys, "first_b", "last_b", "b", "c", F.explode(F.when(fills, F.sequence(F.col("b"), until - 1))).alias("at"))
    return filled.select(
        *keys,
        bucket_start(F.col("at"), bucket).alias("ts"),
        (F.col("at") - F.col("first_b")).alias("idx"),
        (F.col("last_b") - F.col("first_b") + 1).alias("n"),
        F.when(F.col("at") == F.col("b"), F.col("c")).otherwise(F.lit(0)).cast("double").alias("y"),
    )


def demand_series(
    events: DataFrame,
    ts_col: str = "ts",
    keys: Sequence[str] = (),
    bucket: str = "hour",
    start: str | None = None,
    end: str | None = None,
    common_range: bool = False,
    max_buckets: int | None = None,
) -> DataFrame:
    """Event log to series: bounds, count, fill."""
    counts = count_buckets(between(events, ts_col, start, end), ts_col, keys, bucket)
    return fill_gaps(counts, keys, bucket, common_range, max_buckets)


def series_extent(series: DataFrame, keys: Sequence[str] = (), extra: Sequence[str] = ()) -> DataFrame:
    """Rows, first and last timestamp per key (and e.g. per split)."""
    return series.groupBy(*keys, *extra).agg(
        F.count("*").alias("n"), F.min("ts").alias("min_ts"), F.max("ts").alias("max_ts")
    )


def rescale_sampled(series: DataFrame, frac: float) -> DataFrame:
    """Counts of a sampled log brought back to the size of the whole log."""
    return series.withColumn("y", F.col("y") / F.lit(frac))


def sample_rows(df: DataFrame, frac: float, seed: int = 42) -> DataFrame:
    """About ``frac`` of the rows, drawn in the scan; the whole table when ``frac`` is 1."""
    return df if frac >= 1 else df.sample(withReplacement=False, fraction=frac, seed=seed)


def sample_by_hash(df: DataFrame, id_col: str, frac: float) -> DataFrame:
    """Reproducible sample: a fixed multiplicative hash of the id falls below ``frac``."""
    return df.where(_id_hash(id_col) < math.ceil(frac * 4294967296))


def sample_exact(df: DataFrame, id_col: str, frac: float, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Exactly ``round(frac * rows)`` rows without replacement: those of the smallest id hashes, among equal
    hashes those of the smallest ids.

    The last hash that is kept whole is found digit by digit: one count per digit's value and pass,
    over the rows that agree in the digits before. Only a slice of at most ``slice_rows`` rows is ever put in
    order; rows alike in every column are exchangeable and need none.
    """
    total = df.count()
    keep = round(frac * total)
    if not 0 < keep < total:
        return df if keep else df.limit(0)
    return _smallest(df.withColumn("_h", _id_hash(id_col)), id_col, keep, slice_rows).drop("_h")


def _id_hash(id_col: str):
    """``id * 2654435761 mod 2^32`` without leaving 64 bits for any id."""
    # The multiplier of Knuth's multiplicative hash, 2^31 and 2^32.
    low = F.pmod(F.col(id_col), F.lit(2147483648))
    high = F.pmod(F.col(id_col), F.lit(4294967296)) - low
    return F.pmod(low * F.lit(2654435761) + high, F.lit(4294967296))


def _digits(df: DataFrame, id_col: str) -> list:
    """Digits of 16 bits, most significant first: of the hash, of the id, of a hash over the whole row."""
    ident, row = F.col(id_col).cast("bigint"), F.xxhash64(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns])
    words = [(F.col("_h"), (16, 0)), (ident, (48, 32, 16, 0)), (row, (48, 32, 16, 0))]
    cut = lambda v, shift: F.shiftright(v, shift).bitwiseAND(65_535)
    digits = [cut(v, shift) for v, shifts in words for shift in shifts]
    # Negative numbers come first: the sign bit is turned round.
    for at in (2, 6):
        digits[at] = digits[at].bitwiseXOR(32_768)
    return digits


def _smallest(df: DataFrame, id_col: str, keep: int, slice_rows: int) -> DataFrame:
    """The ``keep`` rows smallest by (hash, id, hash of the row), without a global sort."""
    whole, same, rest = F.lit(False), F.lit(True), df
    for digit in _digits(df, id_col):
        # At most 65,536 counts, however many rows.
        counts = sorted((r[0], r[1]) for r in rest.groupBy(digit.alias("d")).agg(F.count("*").alias("c")).collect())
        for cut, held in counts:
            if keep <= held:
                break
            keep -= held
        whole, same = whole | (same & (digit < cut)), same & (digit == cut)
        rest = df.where(same)
        if keep == held:
            return df.where(whole | same)
        if held <= slice_rows:
            order = Window.orderBy("_h", id_col, *[F.col(f"`{c}`").cast("string") for c in df.columns])
            part = rest.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= keep).drop("_r")
            return df.where(whole).unionByName(part)
    # All rows left are alike: one of them, as often as rows are wanted.
    return df.where(whole).unionByName(rest.limit(1).withColumn("_r", F.explode(F.sequence(F.lit(1), F.lit(keep)))).drop("_r"))
