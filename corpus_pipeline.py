"""From raw documents to shards, each stage written and read back before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandtide.llm import base, decontamination, jaccard, mixing, quality, sharding, sql
from demandtide.sources import tables as tb


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line and document rules accept."""
    return quality.clean(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the row with the smallest id, null last; of several rows of that id
    the one of the smallest hash over all columns, once."""
    key = base.column_name("row_key", docs.columns)
    cells = [F.col(f"`{c}`") for c in docs.columns]
    # Nulls leave the hash as it is, so their places are hashed too.
    row = F.xxhash64(*cells, *[c.isNull() for c in cells])
    keyed = docs.withColumn(key, F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), row.alias("row")))
    found = jaccard.near_duplicates(keyed, doc_id=key)
    keep = base.kept(found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy(F.col("doc_id").alias("kept_key")).agg(F.count("*").alias("n")), "kept-keys")
    one = lambda wanted: keyed.join(keep.filter(wanted).select("kept_key"), keyed[key].eqNullSafe(F.col("kept_key")), "left_semi")
    out = one("n = 1")
    if not keep.filter("n > 1").isEmpty():
        out = out.unionByName(one("n > 1").dropDuplicates([key]))
    return out.select(*cells)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontamination.without_contaminated(docs, tb.table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's weight asks."""
    return mixing.replicate(docs, mixing.target_rates(docs, "source")).select(*docs.columns)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the shard they belong to."""
    return sharding.shard(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", benchmark_free),
    ("mixing sources", mixed),
    ("sharding", sharded),
]

#: DuckDB's SQL for the rows of ``run``.
ORACLE_SQL = sql.PIPELINE


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = tb.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = base.kept(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
