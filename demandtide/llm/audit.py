"""How filters act together: what each one removes in every order, and its Shapley share.

For a part of the corpus the filters play a removal game: a set S of filters (a coalition) is worth
the documents v(S) that fail any of its filters. All 32 coalitions are valued from the counts of
documents per set of failed filters. Hart and Mas-Colell's potential follows by recursion over the
coalitions, smaller ones first: P of none is 0 and

    |S| P(S) = v(S) + sum over i in S of P(S without i).

A filter's Shapley value is P(all) - P(all without it); times the number of orders it is a whole
number, so the recursion runs on whole numbers. What a filter removes behind the set S is the
difference v(S with it) - v(S); no order is ever played through.

Documents meet only as counts: a text by its hash, so a text that a third of all rows share is one
row per task before the shuffle.

Defined results: a null text is empty, a null part the empty string; an empty table gives no rows.
A document without a row in ``labels`` is neither good nor toxic, one with several is if any says so.
Rows that repeat a doc_id count each, and none of them is a copy of the others; a null doc_id is
smaller than none and larger than none, so its row is never a copy and makes none. Other columns are
not read. Texts are compared by SHA-256.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandtide.llm import base

#: The letter of the filter on copies; the others look at a text alone.
COPY = "E"


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions of the filters that need one text only."""
    words = base.words(text, base.SPACE)
    return {
        "A": F.size(words) < 100,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 80,
        "C": F.length(F.regexp_replace(text, "[^A-Z]+", "")) * 100 > F.length(text) * 10,
        "D": text.rlike(r"[#$%&*|]"),
    }


def _bits(failed: dict[str, Column], letters: str) -> Column:
    return sum((F.when(c, 1 << letters.index(x)).otherwise(0) for x, c in failed.items()), F.lit(0))


def failed_sets(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang", letters: str = "ABCDE") -> DataFrame:
    """``part, failed, n, good, toxic``: documents of a part by the set of filters they fail (bit i
    for the i-th letter). Several rows may have the same part and set."""
    whole = F.coalesce(F.col(text), F.lit(""))
    docs = docs.select(
        F.col(doc_id).alias("id"),
        # Rows without an id meet no label; they stay spread.
        F.when(F.col(doc_id).isNull(), F.spark_partition_id()).otherwise(0).alias("slot"),
        F.coalesce(F.col(part), F.lit("")).alias("part"),
        F.unhex(F.sha2(whole, 256)).alias("text_key"),
        _bits(text_filters(whole), letters).alias("alone"),
    )
    flags = labels.groupBy(F.col("doc_id").alias("id")).agg(F.bool_or(F.col("quality").eqNullSafe(1)).alias("good"), F.bool_or(F.col("toxic").eqNullSafe(1)).alias("toxic")).withColumn("slot", F.lit(0))
    rows = docs.groupBy("id", "slot", "part", "text_key", "alone").agg(F.count("*").alias("n")).join(flags, ["id", "slot"], "left")
    flag = [F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]
    same = rows.groupBy("text_key", "part", "alone", *flag).agg(
        F.min("id").alias("least"), F.min_by("n", "id").alias("n_least"), F.sum("n").alias("n"), F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("n_null")
    )
    # One row per text, part and labels is left, so a text's rows are few.
    smallest = F.min("least").over(Window.partitionBy("text_key"))
    first = F.col("n_null") + F.when(F.col("least") == F.col("smallest"), F.col("n_least")).otherwise(0)
    same = same.withColumn("smallest", smallest).withColumn("first", first)
    copy = 1 << letters.index(COPY)
    each = F.explode(F.array(F.struct(F.col("alone").alias("failed"), F.col("first").alias("n")), F.struct((F.col("alone") + copy).alias("failed"), (F.col("n") - F.col("first")).alias("n"))))
    return same.select("part", "good", "toxic", each.alias("x")).select("part", "x.failed", "x.n", F.when(F.col("good"), F.col("x.n")).otherwise(0).alias("good"), F.when(F.col("toxic"), F.col("x.n")).otherwise(0).alias("toxic"))


def _potential(worth, size: int, scale: int) -> Column:
    """The potential of every coalition times ``scale``, from the array of their worths."""

    def one(done: Column, s: Column) -> Column:
        without = sum((F.when(s.bitwiseAND(1 << i) != 0, F.get(done, s - (1 << i))).otherwise(0) for i in range(size)), F.lit(0))
        # Always whole: the denominators of a coalition's potential divide its size's factorial.
        return F.concat(done, F.array(F.call_function("div", worth(s) * scale + without, F.bit_count(s))))

    return F.aggregate(F.sequence(F.lit(1), F.lit((1 << size) - 1)), F.array(F.lit(0).cast("bigint")), one)


def interaction_audit(sets: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """One row per part, order of all filters and step, from the counts of ``failed_sets``."""
    size = len(letters)
    every = (1 << size) - 1
    cells = sets.groupBy("part", "failed").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
    hit = F.col("failed").bitwiseAND(F.col("s")) != 0
    games = cells.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(every)))).groupBy("part", "s").agg(
        *[F.sum(F.when(hit, F.col(c)).otherwise(0)).alias(c) for c in ("n", "good", "toxic")],
        F.sum("n").alias("all"),
        F.sum(F.when(F.col("failed") == F.col("s"), F.col("n")).otherwise(0)).alias("exact"),
    )
    # A row per part: its coalitions in order, so a coalition's number is its place.
    games = games.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("s", "n", "good", "toxic", "all", "exact"))).alias("v"))
    of = lambda s, field: F.get(F.col("v"), s)[field]
    games = games.withColumn("p", _potential(lambda s: of(s, "n"), size, math.factorial(size)))
    orders = F.array(*[F.lit("".join(o)) for o in itertools.permutations(letters)])
    steps = games.select("*", F.explode(orders).alias("filter_order")).select("*", F.explode(F.sequence(F.lit(1), F.lit(size))).alias("step"))
    before = sum((F.when(F.locate(x, F.col("filter_order")).between(1, F.col("step") - 1), 1 << i).otherwise(0) for i, x in enumerate(letters)), F.lit(0))
    here = F.expr(f"shiftleft(1, instr('{letters}', substr(filter_order, step, 1)) - 1)")
    steps = steps.withColumn("before", before).withColumn("own", here).withColumn("after", F.col("before") + F.col("own"))
    gone = lambda field: of(F.col("after"), field) - of(F.col("before"), field)
    return steps.select(
        "part",
        "filter_order",
        "step",
        (of(F.lit(0), "all") - of(F.col("after"), "n")).alias("kept"),
        gone("n").alias("removed"),
        (of(F.col("own"), "n") - gone("n")).alias("redundant"),
        of(F.col("own"), "exact").alias("unique_fails"),
        gone("good").alias("good_lost"),
        gone("toxic").alias("toxic_lost"),
        (F.get("p", F.lit(every)) - F.get("p", F.lit(every) - F.col("own"))).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters over all documents, part by part of their language."""
    return interaction_audit(failed_sets(docs, labels))
