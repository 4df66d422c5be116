"""Mixing sources to target weights by Poisson replication.

Each source has a target share of the mixed corpus. A document of source ``s`` is repeated
``Poisson(rate)`` times, ``rate = share x total x size / size of s``: its mean repetition gives the source its
share. The draw inverts the distribution at a number hashed from the document's id and the seed,
so a rerun, or a task run again after a lost executor, draws the same. A rate above
``LARGEST_RATE`` is drawn as the sum of independent equal parts. Copies are then dealt to random
partitions and ordered at random within them by a second hash.

Native: DataFrame functions only. The sources' table has one row per source and is joined by a
shuffle or, when counted as small, by broadcast.

Defined results: a null source is a source of its own; a null id draws like the text "null"; a
source without a stated weight weighs ``default_weight``; weights of absent sources are left out and
the others rescaled; repeated rows draw equal counts; empty tables give empty tables; an input column
called like one of the two new columns (``copy``, ``draw``) keeps its name, the new one gets an
underscore in front.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandtide.llm import base

#: Largest rate drawn by one inversion: exp(-16) and its sums are far from the end of doubles.
LARGEST_RATE = 16.0
#: Terms of the distribution kept: beyond the 80th, at a rate of 16, lies less than 1e-27.
TERMS = 80
#: Sources up to which their table is broadcast.
BROADCAST_SOURCES = 100_000


def uniform(doc_id: Column, *salt: Column | str) -> Column:
    """A number in [0, 1) with 52 random bits, from the id and the salts."""
    parts = [F.coalesce(doc_id.cast("string"), F.lit("null")), *[F.lit(s) if isinstance(s, str) else s.cast("string") for s in salt]]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def target_rates(docs: DataFrame, source: str, weights: dict[str, float] | None = None, alpha: float = 0.5, default_weight: float = 1.0, size: Column | None = None, epochs: float = 1.0) -> DataFrame:
    """Per source: its rows' ``size``, target share and mean repetition ``rate``.

    ``weights`` states target weights; without it a source weighs ``size ** alpha``, which
    flattens the differences between sources.
    """
    sizes = docs.groupBy(F.col(source).alias("source")).agg(F.sum(size if size is not None else F.lit(1)).cast("double").alias("size"))
    if weights is None:
        weight = F.pow("size", F.lit(alpha))
    else:
        weight = F.lit(float(default_weight))
        for s, v in sorted(weights.items(), reverse=True):
            weight = F.when(F.col("source") == s, F.lit(float(v))).otherwise(weight)
    weighed = base.kept(sizes.withColumn("weight", weight), "source-sizes")
    total = weighed.agg(F.sum("weight").alias("w"), F.sum("size").alias("n")).select(F.struct("w", "n").alias("t")).scalar()
    both = weighed.withColumn("t", total)
    share = F.col("weight") / F.col("t.w")
    return both.select("source", "size", share.alias("share"), F.when(F.col("size") > 0, share * F.col("t.n") * F.lit(float(epochs)) / F.col("size")).otherwise(F.lit(0.0)).alias("rate"))


def _distribution(rate: Column) -> Column:
    """Cumulative probabilities of 0, 1, ... repetitions."""
    start = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("c"))

    def step(acc: Column, k: Column) -> Column:
        p = acc["p"] * rate / k
        return F.struct(p.alias("p"), F.concat(acc["c"], F.array(F.element_at(acc["c"], -1) + p)).alias("c"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, step, lambda acc: acc["c"])


def replicate(docs: DataFrame, rates: DataFrame, doc_id: str = "doc_id", source: str = "source", seed: str = "mix", partitions: int | None = None) -> DataFrame:
    """Every copy of every document: the columns of ``docs``, ``copy`` (from 1) and ``draw`` (the
    random number that orders the copies), dealt to random partitions."""
    taken = list(docs.columns)
    names = {}
    for c in ("copy", "draw", "r_source", "rate_parts", "part_distribution"):
        names[c] = base.column_name(c, taken)
        taken.append(names[c])
    parts = F.greatest(F.ceil(F.col("rate") / LARGEST_RATE), F.lit(1)).cast("int")
    table = rates.select(F.col("source").alias(names["r_source"]), parts.alias(names["rate_parts"]), _distribution(F.col("rate") / parts).alias(names["part_distribution"]))
    table = base.kept(table, "source-rates")
    joined = docs.join(base.small(table, BROADCAST_SOURCES), docs[source].eqNullSafe(table[names["r_source"]]))
    below = lambda u: F.size(F.filter(F.col(names["part_distribution"]), lambda c: c <= u))
    count = F.aggregate(F.sequence(F.lit(1), F.col(names["rate_parts"])), F.lit(0), lambda acc, j: acc + below(uniform(docs[doc_id], seed, j)))
    copies = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    out = joined.select(*[docs[f"`{c}`"] for c in docs.columns], F.explode(copies).alias(names["copy"]))
    out = out.withColumn(names["draw"], uniform(F.col(f"`{doc_id}`"), seed, "order", F.col(names["copy"])))
    by = F.col(names["draw"])
    dealt = out.repartition(partitions, by) if partitions else out.repartition(by)
    return dealt.sortWithinPartitions(by)
