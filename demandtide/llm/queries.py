"""One query per operator, over its whole table, with the parameters meant for production."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandtide.llm import archives, audit, decontamination, jaccard, katz, mixing, personal, pieces, quality, search, sharding, templates, toolcalls
from demandtide.sources import tables as tb


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(tb.table(spark, sf_dir, "documents"), tb.table(spark, sf_dir, "benchmark")).drop("text_key")


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.personal_data(tb.table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of at most 1 MiB of text."""
    docs = sharding.shard(tb.table(spark, sf_dir, "documents"))
    return docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"), "shard", "shard_bytes", "oversized")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judged(tb.table(spark, sf_dir, "documents").select("doc_id", "text"))
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_failed_lines", "lost_chars")
    return judged.select("doc_id", *[F.col("q")[f].alias(f) for f in fields])


def op5_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.katz_scores(tb.table(spark, sf_dir, "documents"))


def op6_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.main_text(tb.table(spark, sf_dir, "pages"))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(tb.table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources weighed by the square root of their documents, whole documents repeated."""
    docs = tb.table(spark, sf_dir, "documents")
    return mixing.replicate(docs, mixing.target_rates(docs, "source"))


def op9_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user turn as a call answered by the assistant's next turn."""
    calls, results = toolcalls.calls_of(tb.table(spark, sf_dir, "conversations"))
    return toolcalls.link(calls, results, toolcalls.reply_schema(spark))


def op10_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archives.round_trip(spark, tb.table(spark, sf_dir, "pages"))


def op11_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids with the end id, their number, and the text they decode to; covered: bytes the spans cover."""
    import public_tokenizers

    model = pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    coded = pieces.encode(tb.table(spark, sf_dir, "documents"), model)
    digests = coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), F.element_at("ends", -1).cast("bigint").alias("covered"), "ids")
    return pieces.decode(digests, model).withColumn("decoded_sha256", F.sha2("decoded", 256)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "covered")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(tb.table(spark, sf_dir, "documents"), tb.table(spark, sf_dir, "labels"))


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked(tb.table(spark, sf_dir, "documents"), tb.table(spark, sf_dir, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (op1_decontamination, op2_personal_data, op3_sharding, op4_quality, op5_katz, op6_site_templates, op7_ngram_jaccard, op8_mixing, op9_tool_calls, op10_archives, op11_pieces, op12_filter_audit, op13_search)
}
