"""Benchmark decontamination: which documents hold windows of benchmark items.

A prefix-filtered set join. A window (``window`` consecutive words of an item, or the whole
of a shorter item) is the set of its word shingles. Whole containment needs every shingle,
so one of them, the rarest over the corpus, is the necessary prefix: windows are indexed by
that shingle alone. Document shingles meet the index by hash; the shingle's place in the
window bounds where the window must start and end; the words there are then compared.

Before the join, document shingles pass a bitmap of the benchmark's shingles, whose size is
fixed, so the corpus is read once and only shingles that may matter leave it.

Native: DataFrame functions only.

Defined results: a null or wordless text has n_words 0 and no hits; an item without words has
no window; equal items all count; an item without id is found but not among the listed items; repeated rows get equal results each; an empty benchmark
leaves every document clean. Other columns of either table are not read.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandtide.llm import base

#: 64-bit words of the bitmap: 2**14 of them are 128 KiB, whatever the tables' size.
#: A fuller bitmap lets more shingles through to the join; none that matters is lost.
BITMAP_WORDS = 1 << 14
#: Windows up to which the index is broadcast; beyond it a shuffle join takes over.
BROADCAST_WINDOWS = 50_000


def _shingles(w: Column, size: int) -> Column:
    """Hash of the ``size`` words from each position on."""
    places = F.sequence(F.lit(0), F.size(w) - size)
    hashed = F.transform(places, lambda i: F.xxhash64(*[w[i + k] for k in range(size)]))
    return F.when(F.size(w) >= size, hashed).otherwise(F.array().cast("array<bigint>"))


def _windows(benchmark: DataFrame, item_id: str, text: str, window: int, shingle: int) -> DataFrame:
    """Distinct windows: ``w`` (words), ``size`` (words a shingle), ``items`` (ids as strings)."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), base.words(base.lower_az(F.col(text)), base.NOT_ALNUM).alias("w"))
    n = F.size("w")
    starts = F.sequence(F.lit(0), F.greatest(n - window, F.lit(0)))
    cut = items.filter(n > 0).select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i + 1, F.lit(window)))).alias("w"))
    return cut.groupBy("w").agg(F.collect_set("item").alias("items")).withColumn("size", F.least(F.size("w"), F.lit(shingle)))


def _places(h: Column) -> list[tuple[Column, Column]]:
    """Word and bit of the bitmap, twice, from separate bits of the hash."""
    return [(F.shiftrightunsigned(h, s).bitwiseAND(F.lit(BITMAP_WORDS - 1)).cast("int"), F.shiftrightunsigned(h, s + 14).bitwiseAND(F.lit(63)).cast("int")) for s in (0, 20)]


def _bitmap(hashes: DataFrame) -> Column:
    """The set of hashes ``h`` as a constant array of ``BITMAP_WORDS`` longs.

    At most that many rows reach the driver. Subqueries may not stand inside ``filter``."""
    places = F.array(*[F.struct(at.alias("at"), bit.alias("bit")) for at, bit in _places(F.col("h"))])
    bits = hashes.select(F.explode(places).alias("x")).select("x.at", F.expr("shiftleft(1L, x.bit)").alias("bit"))
    full = [0] * BITMAP_WORDS
    for r in bits.groupBy("at").agg(F.bit_or("bit").alias("bit")).collect():
        full[r["at"]] = r["bit"]
    return F.from_json(F.lit(json.dumps(full, separators=(",", ":"))), "array<bigint>")


def _in_bitmap(bits: Column, h: Column) -> Column:
    (at1, bit1), (at2, bit2) = _places(h)
    return (F.getbit(bits[at1], bit1) == 1) & (F.getbit(bits[at2], bit2) == 1)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    shingle: int = 5,
) -> DataFrame:
    """One row per document row: doc_id, text_key (hash of the text), n_words, n_hit (words inside
    a window), n_items, items_sha256 (of the sorted item ids, comma-joined), contaminated."""
    wins = base.kept(_windows(benchmark, item_id, item_text, window, shingle), "windows")
    sizes = sorted(r["size"] for r in wins.select("size").distinct().collect())
    tokens = [wins.filter(F.col("size") == s).select("w", "items", "size", F.posexplode(_shingles(F.col("w"), s)).alias("off", "h")) for s in sizes]
    doc = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_key"), base.words(base.lower_az(F.col(text)), base.NOT_ALNUM).alias("w"))
    found = [_candidates(s, t, window) for s, t in zip(sizes, tokens)]
    for s in sizes:
        doc = doc.withColumn(f"h{s}", _shingles(F.col("w"), s))
    hits = F.concat(*[f(F.col(f"h{s}")) for s, f in zip(sizes, found)]) if sizes else F.lit(None).cast("array<struct<pos:int,size:int,h:bigint,at:int,near:array<string>>>")
    doc = base.kept(doc.select("doc_id", "text_key", F.size("w").cast("bigint").alias("n_words"), hits.alias("hits")), "shingle-hits")
    out = doc.select("doc_id", "text_key", "n_words")
    if sizes:
        out = out.join(_matched(doc, tokens), on=[out.doc_id.eqNullSafe(F.col("m_id")), out.text_key == F.col("m_key")], how="left")
    else:
        out = out.withColumns({"n_hit": F.lit(None).cast("bigint"), "items": F.array().cast("array<string>")})
    n_hit, items = F.coalesce("n_hit", F.lit(0).cast("bigint")), F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        "doc_id",
        "text_key",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def _candidates(size: int, tokens: DataFrame, window: int):
    """Places of a document's shingles that the bitmap may hold, with the words around them."""
    bits = _bitmap(tokens.select("h"))
    reach = window - size

    def places(h: Column) -> Column:
        passed = F.filter(F.sequence(F.lit(0), F.size(h) - 1), lambda i: _in_bitmap(bits, h[i]))
        passed = F.when(F.size(h) > 0, passed).otherwise(F.array().cast("array<int>"))

        def around(i: Column) -> Column:
            first = F.greatest(i - reach, F.lit(0))
            return F.struct(i.alias("pos"), F.lit(size).alias("size"), h[i].alias("h"), first.alias("at"), F.slice("w", first + 1, i - first + window).alias("near"))

        return F.transform(passed, around)

    return places


def _matched(doc: DataFrame, tokens: list[DataFrame]) -> DataFrame:
    """Words hit and items found of each document that holds a window."""
    hit = doc.select("doc_id", "text_key", "n_words", F.explode("hits").alias("x")).select("doc_id", "text_key", "n_words", "x.*")
    counts = hit.groupBy("size", "h").agg(F.count("*").alias("n"))
    every = tokens[0]
    for t in tokens[1:]:
        every = every.unionByName(t)
    # Inner: a window with a shingle that the corpus lacks is nowhere; min_by takes the rarest of the others.
    rare = every.join(counts, ["size", "h"], "left").groupBy("w").agg(
        F.min_by(F.struct("off", "h", "size", "items"), F.struct(F.coalesce("n", F.lit(0).cast("bigint")), "h", "off")).alias("x")
    )
    index = base.kept(rare.select("w", "x.*"), "window-index")
    start = F.col("pos") - F.col("off")
    fits = (start >= 0) & (start + F.size("w") <= F.col("n_words"))
    same = F.slice("near", start - F.col("at") + 1, F.size("w")) == F.col("w")
    # "and" does not bind the order of evaluation; slice() needs a start of 1 or more.
    pairs = hit.join(base.small(index, BROADCAST_WINDOWS), ["size", "h"]).filter(F.when(fits, same).otherwise(False))
    per = pairs.groupBy(F.col("doc_id").alias("m_id"), F.col("text_key").alias("m_key")).agg(
        F.array_sort(F.collect_set(F.struct(start.alias("s"), (start + F.size("w")).alias("e")))).alias("spans"),
        F.collect_set("items").alias("items"),
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("e"), F.lit(0).cast("bigint").alias("n")),
        lambda acc, x: F.struct(F.greatest(acc["e"], x["e"]).alias("e"), (acc["n"] + F.greatest(x["e"] - F.greatest(acc["e"], x["s"]), F.lit(0))).cast("bigint").alias("n")),
        lambda acc: acc["n"],
    )
    return per.select("m_id", "m_key", covered.alias("n_hit"), F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that hold a window, columns unchanged."""
    bad = contamination(docs, benchmark, doc_id, text, **options).filter("contaminated").select(F.col("doc_id").alias("bad_id"), F.col("text_key").alias("bad_key")).distinct()
    return docs.join(bad, on=[docs[doc_id].eqNullSafe(bad["bad_id"]), F.xxhash64(docs[text]) == bad["bad_key"]], how="left_anti")
