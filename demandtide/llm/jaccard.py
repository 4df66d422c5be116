"""N-gram Jaccard join as a blocked sparse matrix product.

Documents by n-grams form a sparse 0/1 matrix A; two documents' overlap is their entry in A·Aᵀ.
Only entries that can reach the threshold are made:

* Equal rows are one row (a *node*), known by a 64-bit hash of its set.
* Columns are ordered from rare to frequent by a count of fixed size over all documents. Two sets
  that reach the threshold t share a column among the first ``n - ceil(t n) + 1`` of each; only this
  part of A is multiplied. The sizes and the column's place in both rows bound the overlap that can
  still be reached; pairs below ``t / (1 + t) (n1 + n2)`` are discarded.
* Columns are blocks dealt out by hash. A column that the count calls hot is cut into salted
  blocks.
* The answer is classes, so a column's nodes are first multiplied with one of them (a star) and with
  their neighbours in a few random orders (chains). Then come rounds: with the classes found so far,
  a node outside a column's largest class meets some nodes of other classes, more in the second round
  than in the first, and classes are joined. A column that is small for its round is multiplied in full
  and is done, the others are in the last round. Copies by the thousand thus cost some pairs each, not a
  square; no link between different classes is missed.
* Overlaps of the remaining pairs are accumulated over whole rows, so every link is exact.

Shingles and sets are 64-bit hashes (among 10**10 different sets about three would share one); two
documents' shingles are compared by 40 of the bits.

Python works on whole Arrow batches inside tasks; Spark deals out, sorts, joins and spills.

Defined results: null, empty and wordless texts have an empty set, link with nothing and are their
own class; a text of fewer than ``n`` words is one shingle; rows that repeat an id are joined like any
others; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from demandtide.llm import base
from demandtide.llm.components import components
from demandtide.llm.hashing import Tables, mix, shingle_sets

#: Counters of the count of fixed size, as a power of two, and the pieces it is merged in.
COUNTER_BITS, PIECES = 20, 32
#: Entries of a column beyond which it is cut into salted blocks.
HOT = 50_000
#: Words of the bitmap of nodes whose rows are needed: 2 MiB, whatever the tables' size.
BITMAP_BITS = 24
#: Nodes of a block whose pairs are all made at once.
SMALL = 8
#: Chains through each block's nodes beside its star.
CHAINS = 4
#: Nodes of other classes that a node meets in a column, round by round; then it meets all of them.
ROUNDS = (128, 2048)
#: Part of a round's partners up to which the nodes outside the largest class, on average over the cells
#: of mixed columns, meet all at once.
FEW = 1 / 8
#: Rows of a pair block compared at once.
BLOCK = 1 << 20

CELL = T.StructType([T.StructField(c, t) for c, t in (("token", T.LongType()), ("salt", T.IntegerType()), ("salts", T.IntegerType()), ("node", T.LongType()), ("n", T.IntegerType()), ("pos", T.IntegerType()))])
PAIR = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _node(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit hashes of a set."""
    one = mix(s ^ np.uint64(0x5851F42D4C957F2D))
    two = mix(s + np.uint64(0x14057B7EF767814F))
    n = np.uint64(len(s))
    return int(mix(np.sum(one, dtype=np.uint64, keepdims=True) + n).view(np.int64)[0]), int(mix(np.bitwise_xor.reduce(two, keepdims=True) ^ n).view(np.int64)[0])


def _least_overlap(n1, n2, percent: int):
    """Smallest overlap o with 100 o >= percent (n1 + n2 - o)."""
    return (percent * (np.int64(1) * n1 + n2) + 99 + percent) // (100 + percent)


def _early(pos, n, percent: int):
    """Whether a node can be the smaller one of a pair that meets first at the place ``pos`` of its
    ``n`` columns: those before are missing in the other."""
    return pos * (100 + percent) <= n * (100 - percent)


def _rare(s: np.ndarray, percent: int, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rarest columns of a row, rare ones first, and how often the count saw them."""
    often = count[(s >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)]
    # Stable: equal counts stay in the order of their hashes.
    order = np.argsort(often, kind="stable")[: len(s) - (percent * len(s) + 99) // 100 + 1]
    return s[order], often[order]


def _rows(docs: DataFrame, n: int) -> DataFrame:
    """One row per document (kind "row"): id, size and hashes of its set; and each task's pieces
    of the count of shingles (kind "count")."""
    schema = T.StructType([T.StructField("kind", T.StringType()), T.StructField("id", docs.schema["id"].dataType), *[T.StructField(c, T.LongType()) for c in ("size", "k1", "k2")], T.StructField("piece", T.IntegerType()), T.StructField("task", T.LongType()), T.StructField("counts", T.BinaryType())])

    def run(batches):
        arrow, tables = to_arrow_schema(schema), Tables()
        counts = np.zeros(1 << COUNTER_BITS, dtype=np.int64)
        for batch in batches:
            size, k1, k2 = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for i, s in shingle_sets(batch.column("text"), n, tables):
                size[i] = len(s)
                if len(s):
                    k1[i], k2[i] = _node(s)
                    np.add.at(counts, (s >> np.uint64(64 - COUNTER_BITS)).astype(np.int64), 1)
            m = batch.num_rows
            empty = [pa.nulls(m, f.type) for f in list(arrow)[5:]]
            yield pa.RecordBatch.from_arrays([pa.array(["row"] * m, pa.string()), batch.column("id").cast(arrow.field("id").type), *map(pa.array, (size, k1, k2)), *empty], schema=arrow)
        if counts.any():
            task = TaskContext.get().partitionId()
            for k, piece in enumerate(np.split(np.minimum(counts, 2**31 - 1).astype(np.uint32), PIECES)):
                yield pa.RecordBatch.from_arrays([pa.array(["count"]), pa.nulls(1, arrow.field("id").type), *[pa.nulls(1, pa.int64())] * 3, pa.array([k], pa.int32()), pa.array([task], pa.int64()), pa.array([piece.tobytes()], arrow.field("counts").type)], schema=arrow)

    return base.kept(docs.mapInArrow(run, schema), "sets", by="kind")


def _counts(pieces: DataFrame) -> np.ndarray:
    """The count over all tasks, added up 64 tasks at a time; 2**COUNTER_BITS numbers at the end."""

    def add(key, pdf):
        total = np.zeros((1 << COUNTER_BITS) // PIECES, dtype=np.int64)
        for x in pdf["counts"]:
            total += np.frombuffer(x, dtype=np.uint32)
        return pd.DataFrame({"piece": [key[0]], "task": [key[1]], "counts": [np.minimum(total, 2**31 - 1).astype(np.uint32).tobytes()]})

    pieces = pieces.select("piece", "task", "counts")
    last = pieces.agg(F.max("task")).first()[0]
    while last is not None:
        pieces = base.kept(pieces.groupBy("piece", F.floor(F.col("task") / 64).alias("task")).applyInPandas(add, pieces.schema), "counts")
        last = last // 64 if last >= 64 else None
    out = np.zeros((PIECES, (1 << COUNTER_BITS) // PIECES), dtype=np.uint32)
    for r in pieces.collect():
        out[r["piece"]] = np.frombuffer(r["counts"], dtype=np.uint32)
    return out.reshape(-1)


def _cells(docs: DataFrame, n: int, percent: int, counts: np.ndarray, hot: int) -> DataFrame:
    """The part of the matrix that is multiplied: each node's rarest columns."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def run(batches):
        arrow, tables, seen = to_arrow_schema(CELL), Tables(), set()
        count = shared.value
        for batch in batches:
            parts = []
            for _, s in shingle_sets(batch.column("text"), n, tables):
                if not len(s):
                    continue
                node = _node(s)[0]
                if node in seen:
                    continue
                if len(seen) < 1 << 20:
                    seen.add(node)
                rare, often = _rare(s, percent, count)
                m = len(rare)
                parts.append((rare, often, np.full(m, node, np.int64), np.full(m, len(s), np.int32), np.arange(m, dtype=np.int32)))
            if parts:
                token, often, node, size, pos = (np.concatenate(x) for x in zip(*parts))
                salts = np.maximum(1, -(-often.astype(np.int64) // hot)).astype(np.int32)
                salt = (mix(node.view(np.uint64)) % salts.astype(np.uint64)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (token.view(np.int64), salt, salts, node, size, pos)], schema=arrow)

    return docs.select("id", "text").mapInArrow(run, CELL)


def _runs(batches, columns: list[str]):
    """Arrays of whole runs of equal (token, salt) from sorted batches. A block's rows are bounded
    by the salts."""
    rest = None
    for batch in batches:
        now = [batch.column(c).to_numpy(zero_copy_only=False) for c in columns]
        if rest is not None:
            now = [np.concatenate(x) for x in zip(rest, now)]
        token, salt = now[0], now[1]
        if not len(token):
            continue
        edge = np.flatnonzero((token[1:] != token[:-1]) | (salt[1:] != salt[:-1])) + 1
        cut = int(edge[-1]) if len(edge) else 0
        if cut:
            yield [x[:cut] for x in now], np.concatenate(([0], edge))
        rest = [x[cut:] for x in now]
    if rest is not None and len(rest[0]):
        yield rest, np.array([0, len(rest[0])])


def _star(cells: DataFrame, percent: int) -> DataFrame:
    """Pairs of nodes of one block that can reach the threshold (kind "pair"): all of a block of up to
    ``SMALL`` nodes, else those of its star and chains. The cells (kind "cell") of larger blocks with an
    early node and of all salted blocks go on."""
    schema = T.StructType([T.StructField("kind", T.StringType()), *CELL.fields, *PAIR.fields])

    def run(batches):
        arrow = to_arrow_schema(schema)
        for cols, edge in _runs(batches, [f.name for f in CELL.fields]):
            # Equal nodes, from copies, lie side by side.
            first = np.repeat(edge[:-1], np.diff(edge))
            new = np.ones(len(first), dtype=bool)
            new[1:] = (cols[3][1:] != cols[3][:-1]) | (first[1:] != first[:-1])
            token, salt, salts, node, n, pos = (x[new] for x in cols)
            edge = np.concatenate(([0], np.cumsum(np.add.reduceat(new, edge[:-1]))))
            size = np.diff(edge)
            lead = np.repeat(edge[:-1], size)
            block = np.repeat(size, size)
            small = (block <= SMALL) & (salts == 1)
            # The first node is one of those early enough to be the smaller of a pair.
            large = ~small & _early(pos[lead].astype(np.int64), n[lead].astype(np.int64), percent)
            left, right = [], []
            for step in range(1, SMALL):
                one = np.flatnonzero((lead[step:] == lead[:-step]) & small[step:])
                left.append(one)
                right.append(one + step)
            at = np.flatnonzero((node != node[lead]) & large)
            left.append(lead[at])
            right.append(at)
            big = np.flatnonzero(large)
            for seed in range(CHAINS if len(big) else 0):
                # Neighbours in an order drawn by hash, the same in every column.
                order = big[np.lexsort((mix(node[big].view(np.uint64) ^ np.uint64(seed * 0x9E3779B9 + 1)), lead[big]))]
                same = lead[order[:-1]] == lead[order[1:]]
                left.append(order[:-1][same])
                right.append(order[1:][same])
            a, b = np.concatenate(left), np.concatenate(right)
            ok = np.minimum(n[a] - pos[a], n[b] - pos[b]) >= _least_overlap(n[a], n[b], percent)
            lo, hi = np.minimum(node[a[ok]], node[b[ok]]), np.maximum(node[a[ok]], node[b[ok]])
            if len(lo):
                pairs = np.unique(np.stack([lo, hi], 1), axis=0)
                m = len(pairs)
                yield pa.RecordBatch.from_arrays([pa.array(["pair"] * m, pa.string()), *[pa.nulls(m, f.type) for f in list(arrow)[1:7]], pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=arrow)
            # A column's early nodes may all have other salts.
            on = np.flatnonzero(large | (salts > 1))
            if len(on):
                yield pa.RecordBatch.from_arrays([pa.array(["cell"] * len(on), pa.string()), *[pa.array(x[on]) for x in (token, salt, salts, node, n, pos)], pa.nulls(len(on), pa.int64()), pa.nulls(len(on), pa.int64())], schema=arrow)

    late = ~_early(F.col("pos").cast("bigint"), F.col("n").cast("bigint"), percent)
    dealt = cells.repartition("token", "salt").sortWithinPartitions("token", "salt", late, "node")
    return base.kept(dealt.mapInArrow(run, schema), "stars", by="kind")


def _mixed(cells: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """The cells of columns that hold nodes of several classes, with their class, the column's largest
    one (``main``), its nodes (``size``) and those outside that class (``others``). Columns without an early
    node in any of their blocks have none that another column does not show."""
    known = cells.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    known = base.kept(known.select(*CELL.fieldNames(), "label"), "labelled")
    early = _early(F.col("pos").cast("bigint"), F.col("n").cast("bigint"), percent)
    sizes = known.groupBy("token", "label").agg(F.count("*").alias("c"), F.bool_or(early).alias("early"))
    main = sizes.groupBy("token").agg(F.max_by("label", F.struct("c", "label")).alias("main"), F.count("*").alias("classes"), F.bool_or("early").alias("early"), F.sum("c").alias("size"), F.max("c").alias("c"))
    return base.kept(known.join(main.filter("classes > 1 AND early").select("token", "main", "size", (F.col("size") - F.col("c")).alias("others")), "token"), "mixed")


def _between(mixed: DataFrame, percent: int, partners: int | None, turn: int) -> DataFrame:
    """Pairs of nodes of one column but of different classes that can reach the threshold: all of them,
    or for each node outside the column's largest class those with the ``partners`` nodes behind it in
    an order drawn by ``turn``."""
    # Nodes outside the largest class go to each of a column's salted blocks, or to one of them; the others stay.
    rows = mixed.withColumn("minor", F.col("label") != F.col("main"))
    if partners is None:
        salts = F.when(F.col("minor"), F.sequence(F.lit(0), F.col("salts") - 1)).otherwise(F.array("salt"))
        rows = rows.withColumn("salt", F.explode(salts))
    else:
        drawn = F.pmod(F.xxhash64("node", F.lit(turn)), F.col("salts")).cast("int")
        rows = rows.withColumn("salt", F.when(F.col("minor"), drawn).otherwise(F.col("salt")))
    names = ["token", "salt", "node", "n", "pos", "label", "minor"]

    def run(batches):
        arrow = to_arrow_schema(PAIR)
        for cols, edge in _runs(batches, names):
            _, _, node, n, pos, label, minor = cols
            found = []

            def meet(a: np.ndarray, b: np.ndarray) -> None:
                ok = (label[a] != label[b]) & (np.minimum(n[a] - pos[a], n[b] - pos[b]) >= _least_overlap(n[a], n[b], percent))
                x, y = (node[i[ok]] for i in np.broadcast_arrays(a, b))
                if len(x):
                    found.append(np.stack([np.minimum(x, y), np.maximum(x, y)], 1))
                if sum(map(len, found)) > BLOCK:
                    found[:] = [np.unique(np.concatenate(found), axis=0)]

            for lo, hi in zip(edge[:-1], edge[1:]):
                mine = np.flatnonzero(minor[lo:hi]) + lo
                size = hi - lo
                if partners is None or partners >= size - 1:
                    for i in range(0, len(mine), max(1, BLOCK // size)):
                        meet(mine[i : i + max(1, BLOCK // size), None], np.arange(lo, hi)[None, :])
                    continue
                # The same order in every column, so that its nodes meet the same ones there.
                order = lo + np.argsort(mix(node[lo:hi].view(np.uint64) ^ np.uint64(turn * 0x9E3779B9 + 7)), kind="stable")
                place = np.empty(size, np.int64)
                place[order - lo] = np.arange(size)
                for step in range(1, partners + 1):
                    meet(mine, order[(place[mine - lo] + step) % size])
            if found:
                pairs = np.unique(np.concatenate(found), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=arrow)

    dealt = rows.select(*names).repartition("token", "salt").sortWithinPartitions("token", "salt")
    return dealt.mapInArrow(run, PAIR).distinct()


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """The set of hashes ``h`` as bits, by their leading bits; the array's size is fixed."""
    at = F.shiftrightunsigned("h", 64 - BITMAP_BITS)
    words = hashes.select(F.shiftright(at, 6).alias("at"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {64 - BITMAP_BITS}) & 63 AS int))").alias("bit"))
    out = np.zeros(1 << (BITMAP_BITS - 6), dtype=np.int64)
    rows = words.groupBy("at").agg(F.bit_or("bit").alias("bit")).toArrow()
    out[rows["at"].to_numpy()] = rows["bit"].to_numpy()
    return out.view(np.uint64)


def _rows_of(docs: DataFrame, nodes: DataFrame, classes: DataFrame, n: int, form) -> DataFrame:
    """``node, cells``: what ``form`` makes of the sets of ``nodes``, as bytes.

    Each node's set is made from the document of its smallest id. The bitmap of those ids lets a few
    other documents through, whose rows meet no pair or repeat one."""
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("cells", T.BinaryType())])
    ids = nodes.join(classes.select(F.col("k1").alias("node"), "least"), "node").select(F.xxhash64("least").alias("h"))
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(ids))

    def run(batches):
        arrow, tables = to_arrow_schema(schema), Tables()
        for batch in batches:
            at = batch.column("h").to_numpy().view(np.uint64) >> np.uint64(64 - BITMAP_BITS)
            wanted = shared.value[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)
            sets = [s for _, s in shingle_sets(batch.column("text").filter(pa.array(wanted.astype(bool))), n, tables) if len(s)]
            yield pa.RecordBatch.from_arrays([pa.array([_node(s)[0] for s in sets], pa.int64()), pa.array([form(s) for s in sets], arrow.field("cells").type)], schema=arrow)

    return base.kept(docs.select(F.xxhash64("id").alias("h"), "text").mapInArrow(run, schema), "rows")


def _whole(s: np.ndarray) -> bytes:
    """A set's hashes to 40 bits: enough to tell the shingles of two documents apart."""
    short = s >> np.uint64(24)
    return short.astype(np.uint32).tobytes() + (short >> np.uint64(32)).astype(np.uint8).tobytes()


def _read_whole(b: bytes) -> np.ndarray:
    m = len(b) // 5
    return np.frombuffer(b, np.uint32, m).astype(np.uint64) | np.frombuffer(b, np.uint8, m, 4 * m).astype(np.uint64) << np.uint64(32)


def _checked(pairs: DataFrame, rows: DataFrame, passes) -> DataFrame:
    """Those of ``pairs`` whose two rows pass."""
    left = rows.select(F.col("node").alias("a"), F.col("cells").alias("x"))
    right = rows.select(F.col("node").alias("b"), F.col("cells").alias("y"))

    def run(batches):
        arrow = to_arrow_schema(PAIR)
        for batch in batches:
            at = pa.array([i for i, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"))) if passes(x.as_buffer(), y.as_buffer())], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at)], schema=arrow)

    return base.kept(pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, PAIR), "links")


def _links(docs: DataFrame, pairs: DataFrame, classes: DataFrame, n: int, percent: int) -> DataFrame:
    """Those of ``pairs`` that reach the threshold.

    Overlaps are accumulated twice over whole rows: with 16 bits of each column, which can only
    count too many and so discards no link, and, for the pairs left, with 40 bits.
    """

    def nodes(of: DataFrame) -> DataFrame:
        return of.select(F.explode(F.array("a", "b")).alias("node")).distinct()

    def short(s: np.ndarray) -> bytes:
        return np.sort((s & np.uint64(0xFFFF)).astype(np.uint16)).tobytes()

    def may(x, y) -> bool:
        x, y = np.frombuffer(x, np.uint16), np.frombuffer(y, np.uint16)
        (u, c), (v, d) = (np.unique(z, return_counts=True) for z in (x, y))
        _, i, j = np.intersect1d(u, v, assume_unique=True, return_indices=True)
        return int(np.minimum(c[i], d[j]).sum()) >= int(_least_overlap(len(x), len(y), percent))

    def linked(x, y) -> bool:
        x, y = _read_whole(x), _read_whole(y)
        both = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * both >= percent * (len(x) + len(y) - both)

    likely = _checked(pairs, _rows_of(docs, nodes(pairs), classes, n, short), may)
    return _checked(likely, _rows_of(docs, nodes(likely), classes, n, _whole), linked)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 5, percent: int = 75, hot: int = HOT) -> DataFrame:
    """One row per document row: doc_id, n_shingles, component_id (the smallest id that links of
    similarity ``percent`` or more reach)."""
    docs = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    found = _rows(docs, n)
    rows = found.filter("kind = 'row'")
    classes = base.kept(rows.filter("size > 0").groupBy("k1", "k2").agg(F.min("id").alias("least")), "nodes")
    counts = _counts(found.filter("kind = 'count'"))
    stars = _star(_cells(docs, n, percent, counts, hot), percent)
    cells = stars.filter("kind = 'cell'").select(*CELL.fieldNames())
    pairs = base.kept(stars.filter("kind = 'pair'").select("a", "b").distinct(), "star-pairs")
    links = _links(docs, pairs, classes, n, percent)
    labels = components(links)
    for turn, partners in enumerate((*ROUNDS, None)):
        mixed = _mixed(cells, labels, percent)
        others = mixed.agg(F.avg("others")).first()[0]
        if others is None:
            break
        last = partners is None or others <= FEW * partners
        more = base.kept(_between(mixed, percent, None if last else partners, turn).join(pairs, ["a", "b"], "left_anti"), "other-pairs")
        if not more.isEmpty():
            links = links.union(_links(docs, more, classes, n, percent))
            labels = components(links)
            pairs = pairs.union(more)
        if last:
            break
        # Smaller columns have been multiplied in full.
        cells = mixed.filter((F.col("size") > partners + 1) | (F.col("salts") > 1)).select(*CELL.fieldNames())
        if cells.isEmpty():
            break
    labelled = classes.join(labels.select(F.col("node").alias("k1"), "label"), "k1", "left").withColumn("label", F.coalesce("label", "k1"))
    labelled = base.kept(labelled, "classes")
    smallest = labelled.groupBy("label").agg(F.min("least").alias("component"))
    named = base.kept(labelled.join(smallest, "label").select("k1", "k2", "component"), "components")
    return rows.join(named, ["k1", "k2"], "left").select(F.col("id").alias("doc_id"), F.col("size").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
