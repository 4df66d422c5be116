"""Exact percentiles that never hold a whole group in one task.

All percentiles of a group are bracketed by one mergeable sketch. What lies below a bracket is a
count; the values inside are written with their frequencies, once. A bracket that still holds many
different values is cut into ``CELLS`` equal parts, and the part with the wanted rank is the next
bracket, until few values are left to put in order. A bracket that the sketch got wrong is replaced by
the whole range, so the answer is exact in any case.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandtide.operators.attach import attach
from demandtide.session import scratch_dir

# The sketch is off by at most n/ACCURACY ranks; the bracket leaves ten times as much.
ACCURACY = 10_000
MARGIN = 10 / ACCURACY
#: Rows of a group that need no bracket, and different values of a bracket that are put in order at once.
SMALL = 4 * ACCURACY
#: Parts a bracket is cut into.
CELLS = 4096


def exact_percentile(df: DataFrame, keys: Sequence[str], value: str, q: float, name: str = "threshold", small: int = SMALL) -> DataFrame:
    """``q`` quantile (0..1) of ``value`` per key, linear between neighbours; NULLs ignored."""
    return exact_percentiles(df, keys, value, {name: q}, small)


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str, quantiles: dict[str, float], small: int = SMALL) -> DataFrame:
    """Several quantiles per key at once, a column each. A key without values has no row; without keys
    there is always one.

    Reads ``df`` twice, and a third time for keys whose bracket misses. What the brackets hold is
    written under the shared folder. Where every group is small, Spark's own percentile takes them
    whole: its buffer is then bounded too.
    """
    keys = list(keys)
    by = [*keys, "name"]
    known = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("v"))
    largest = known.groupBy(*keys).agg(F.count("*").alias("c")).agg(F.max("c")).first()[0] or 0
    if largest <= min(small, SMALL):
        at = F.percentile("v", F.array(*[F.lit(q) for q in quantiles.values()]))
        return known.groupBy(*keys).agg(at.alias("q")).select(*keys, *[F.col("q")[i].alias(name) for i, name in enumerate(quantiles)])
    points = [x for q in quantiles.values() for x in (max(q - MARGIN, 0.0), min(q + MARGIN, 1.0))]
    stats = known.groupBy(*keys).agg(F.count("*").alias("cnt"), F.min("v").alias("least"), F.max("v").alias("most"), F.percentile_approx("v", points, ACCURACY).alias("near"))
    # A small group is its own bracket; there the margin would be less than one rank.
    whole = F.col("cnt") < SMALL
    brackets = []
    for i, (name, q) in enumerate(quantiles.items()):
        place = F.lit(q) * (F.col("cnt") - 1)
        lo, hi = (F.when(whole, F.col(edge)).otherwise(F.col("near")[2 * i + k]) for k, edge in enumerate(("least", "most")))
        brackets.append(F.struct(F.lit(name).alias("name"), F.floor(place).alias("rank"), (place - F.floor(place)).alias("t"), lo.alias("lo"), hi.alias("hi")))
    wanted = _written(stats.select(*keys, "least", "most", F.explode(F.array(*brackets)).alias("b")).select(*keys, "least", "most", "b.*"))
    answer = _pick(_narrowed(_inside(known, wanted, keys), by, small), by)
    missed = wanted.where(F.col("rank").isNotNull()).join(answer.where(F.col("a").isNotNull() & F.col("b").isNotNull()), by, "left_anti")
    if not missed.isEmpty():
        ranged = missed.withColumn("lo", F.col("least")).withColumn("hi", F.col("most"))
        redone = _pick(_narrowed(_inside(known, ranged, keys), by, small), by)
        answer = answer.join(missed, by, "left_anti").unionByName(redone)
    between = F.col("a") + (F.col("b") - F.col("a")) * F.col("t")
    return answer.groupBy(*keys).agg(*[F.max(F.when(F.col("name") == n, between)).alias(n) for n in quantiles])


def _written(df: DataFrame) -> DataFrame:
    path = scratch_dir(df.sparkSession, "percentile")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _inside(known: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, name, rank, t, v, c``: the values of each bracket with their frequency, and a row with v NULL
    for all rows below it."""
    brackets = wanted.groupBy(*keys).agg(F.collect_list(F.struct("name", "rank", "t", "lo", "hi")).alias("bs"))
    rows = attach(known, brackets, keys, ["bs"])
    hits = rows.select(*keys, "v", F.explode(F.filter("bs", lambda b: b["hi"] >= F.col("v"))).alias("b"))
    # Below a bracket all rows are one before the shuffle.
    shown = F.when(F.col("v") >= F.col("b.lo"), F.col("v"))
    return _written(hits.groupBy(*keys, "b.name", "b.rank", "b.t", shown.alias("v")).agg(F.count("*").alias("c")))


def _narrowed(found: DataFrame, by: list[str], small: int) -> DataFrame:
    """The same with brackets of at most ``small`` values, or of values too close to part."""
    held = F.count("v")
    while True:
        sizes = found.groupBy(*by).agg(held.alias("held"), F.min("v").alias("first"), F.max("v").alias("last"))
        sizes = sizes.withColumn("width", (F.col("last") - F.col("first")) / CELLS).withColumn("large", (F.col("held") > small) & (F.col("width") > 0))
        before = sizes.where("large").agg(F.sum("held")).first()[0]
        if before is None:
            return found
        rows = found.join(sizes, by)
        cell = F.when(F.col("large"), F.least(F.floor((F.col("v") - F.col("first")) / F.nullif(F.col("width"), F.lit(0.0))), F.lit(CELLS - 1))).otherwise(0)
        rows = rows.withColumn("cell", F.when(F.col("v").isNull(), -1).otherwise(cell))
        # At most CELLS + 1 rows per bracket: their running sum is small whatever the group.
        order = Window.partitionBy(*by).orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
        cells = rows.groupBy(*by, "rank", "cell").agg(F.sum("c").alias("n")).withColumn("upto", F.sum("n").over(order))
        reached = lambda r: F.min(F.when(F.col("upto") > r, F.col("cell")))
        ranks = cells.groupBy(*by).agg(reached(F.col("rank")).alias("low"), reached(F.col("rank") + 1).alias("high"))
        # Between the cells of the two neighbouring ranks there is nothing; below the first one all is a count.
        rows = rows.join(ranks, by).where(F.col("cell") <= F.coalesce("high", "low"))
        kept = F.when((F.col("cell") == F.col("low")) | (F.col("cell") == F.col("high")), F.col("v"))
        found = _written(rows.groupBy(*by, "rank", "t", kept.alias("v")).agg(F.sum("c").alias("c")))
        if found.join(sizes.where("large"), by, "left_semi").agg(held).first()[0] >= before:
            return found


def _pick(found: DataFrame, by: list[str]) -> DataFrame:
    """``by, t, a, b``: the values at the two neighbouring ranks; NULL where the bracket does not hold them."""
    # NULL stands for everything below the bracket and sorts first.
    run = Window.partitionBy(*by).orderBy(F.col("v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    ranked = found.withColumn("upto", F.sum("c").over(run))
    at = lambda r: F.min(F.when(F.col("upto") > r, F.struct("upto", "v")))["v"]
    rows = ranked.groupBy(*by, "t").agg(at(F.col("rank")).alias("a"), at(F.col("rank") + 1).alias("b"))
    # The last rank has no neighbour above it and needs none.
    return rows.select(*by, "t", "a", F.when(F.col("t") == 0, F.col("a")).otherwise(F.col("b")).alias("b"))
