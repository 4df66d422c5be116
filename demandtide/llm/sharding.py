"""Sharding by extendible hashing: every shard fits a byte limit.

A document's hash is 60 bits. The directory is indexed by the hash's leading bits; a bucket holds
the documents that share its prefix, and only a bucket over the limit splits on one more bit. The
sizes are added up once per fine prefix and from there rolled up to every depth, so the depth of
each bucket needs no pass over the documents; fine prefixes that are still too large are counted
again with more bits.

Defined results: a null text has 0 bytes; rows equal in id and text share a hash and cannot be
parted: such a group, or a single document, larger than the limit is a shard of its own marked
``oversized``; an empty table has no shard; new columns whose names are taken get an underscore.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandtide.llm import base

#: Bits of a hash: 15 hexadecimal digits.
BITS = 60
#: Bits by which the count is finer than shards of the limit's size would need.
FINER = 5
#: Bits added when fine prefixes are still too large.
MORE = 6
#: Directory entries up to which the directory is broadcast.
BROADCAST_ENTRIES = 1_000_000


def shard_hash(doc_id: Column, text: Column) -> Column:
    """60 bits of the hash of id and text."""
    key = F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(key), 1, BITS // 4), 16, 10).cast("bigint")


def _prefix(h: Column, bits: int) -> Column:
    return F.shiftright(h, BITS - bits)


def directory(sizes: DataFrame, limit: int) -> tuple[list[int], list[DataFrame]]:
    """Of rows ``h, size``: for each number of leading bits counted, the entries
    ``f`` (prefix of so many bits), ``depth`` (bits of its shard), ``bytes``, ``oversized``."""
    total = sizes.agg(F.sum("size")).first()[0] or 0
    bits = min(BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + FINER)
    rest, used, found, least = sizes, [], [], 0
    while True:
        fine = base.kept(
            rest.groupBy(_prefix(F.col("h"), bits).alias("f")).agg(F.sum("size").alias("size"), F.min("h").alias("lo"), F.max("h").alias("hi")),
            "fine-prefixes",
        )
        depths = F.explode(F.sequence(F.lit(least), F.lit(bits))).alias("depth")
        paths = fine.select("*", depths).withColumn("p", F.call_function("shiftright", F.col("f"), (F.lit(bits) - F.col("depth")).cast("int")))
        sums = paths.groupBy("depth", "p").agg(F.sum("size").alias("bytes"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        fits = sums.filter((F.col("bytes") <= limit) | (F.col("lo") == F.col("hi"))).select("depth", "p", "bytes")
        entries = base.kept(
            paths.join(fits, ["depth", "p"]).groupBy("f").agg(F.min_by(F.struct("depth", "bytes"), "depth").alias("x")).select("f", "x.depth", "x.bytes", (F.col("x.bytes") > limit).alias("oversized")),
            "directory",
        )
        used.append(bits)
        found.append(entries)
        if fine.count() == entries.count():
            return used, found
        rest = rest.join(base.small(entries.select("f"), BROADCAST_ENTRIES), _prefix(rest["h"], bits) == F.col("f"), "left_anti")
        least, bits = bits + 1, min(BITS, bits + MORE)


def shard(docs: DataFrame, limit: int = 1 << 20, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``shard`` (the bits of its bucket, "" for the only one), ``shard_bytes`` and
    ``oversized``, dealt so that a shard's rows lie in one partition."""
    hashed = docs.select(shard_hash(F.col(doc_id), F.col(text)).alias("h"), F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("size"))
    used, found = directory(base.kept(hashed, "hashes"), limit)
    taken = list(docs.columns)
    names = {}
    for c in ("shard", "shard_bytes", "oversized", "hash60"):
        names[c] = base.column_name(c, taken)
        taken.append(names[c])
    h = F.col(names["hash60"])
    out = docs.withColumn(names["hash60"], shard_hash(F.col(doc_id), F.col(text)))
    entries = []
    for i, (bits, table) in enumerate(zip(used, found)):
        mine = [base.column_name(f"{c}{i}", taken) for c in ("f", "entry")]
        taken += mine
        side = table.select(F.col("f").alias(mine[0]), F.struct("depth", "bytes", "oversized").alias(mine[1]))
        out = out.join(base.small(side, BROADCAST_ENTRIES), _prefix(h, bits) == F.col(mine[0]), "left")
        entries.append(F.col(mine[1]))
    e = F.coalesce(*entries)
    bits = F.substring(F.lpad(F.conv(h.cast("string"), 10, 2), BITS, "0"), F.lit(1), e["depth"])
    out = out.select(*[F.col(f"`{c}`") for c in docs.columns], bits.alias(names["shard"]), e["bytes"].alias(names["shard_bytes"]), e["oversized"].alias(names["oversized"]))
    return out.repartition(F.col(names["shard"]))
