"""Ranked lexical search: a document index in blocks, searched term by term and document by document.

* The index has one row per block of up to ``BLOCK_DOCS`` documents: their ids and lengths, and for
  every term of the block the list of its documents with its counts. Blocks follow the input's
  partitions, so building it shuffles nothing.
* Documents with terms, all terms and, for the searched terms, documents per term are added up over
  the blocks; scores are whole numbers, so they do not depend on any order.
* Within a block, a searched term's list is short or long, by its share of the block's documents.
  An item's short lists are added up term by term into sums per document. The sums are then one
  more iterator, with a bound per window of ``WINDOW`` documents, beside the long lists with theirs.
  Documents are visited in order: windows, and within them documents, whose bounds together stay
  below the score of the k-th best so far are skipped, the others get their whole score. The sums
  themselves are lower bounds and give the first k-th best.
* A task hands on at most k documents of a block for an item; they are ranked in two rounds.

Items go out to the tasks in batches of at most ``ITEM_BYTES`` of text each (a longer text is a batch
of its own); the index is read once for each batch.

Terms are 64-bit hashes; a document's term that is not an item's shares its hash with odds of one in
10**14 per million searched terms.

Defined results: null and wordless texts have no terms; as documents they are never found and do
not count, as items they find nothing. Rows that repeat an id are ranked like any others, as
documents and as items (each item row has its own ranks). A null doc_id is ranked behind all others
of its score. Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from demandtide.llm import base
from demandtide.llm.hashing import CHUNK, Tables, text_buffers, word_hashes

#: Documents and bytes of text of a block; a longer text is a block of its own.
BLOCK_DOCS, BLOCK_BYTES = 4096, 16 << 20
#: A list is long when it has more than one of so many documents of its block.
SHARE = 8
#: Documents under one bound, and the windows visited before the k-th best is looked up again.
WINDOW, FIRST = 64, 4
#: Bytes of item texts sent to the tasks at once.
ITEM_BYTES = 8 << 20
#: Groups in which an item's documents are ranked before all together.
GROUPS = 64

INDEX = (("lengths", T.BinaryType()), ("terms", T.BinaryType()), ("sizes", T.BinaryType()), ("docs", T.BinaryType()), ("counts", T.BinaryType()), ("n_docs", T.LongType()), ("n_terms", T.LongType()))


def _term_tables() -> Tables:
    """Terms end at every ASCII character but digits and letters."""
    tables = Tables()
    ascii_ = np.arange(128)
    letter = ((ascii_ >= 0x30) & (ascii_ <= 0x39)) | ((ascii_ >= 0x41) & (ascii_ <= 0x5A)) | ((ascii_ >= 0x61) & (ascii_ <= 0x7A))
    tables.space = np.zeros(256, dtype=bool)
    tables.space[:128] = ~letter
    return tables


def _terms(data: np.ndarray, offsets: np.ndarray, tables: Tables) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms of adjacent texts, and how many each text has."""
    parts, lengths, i, n = [], [], 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK, side="right")) - 1)
        j = min(j, n)
        w, first = word_hashes(data, offsets[i : j + 1], tables)
        parts.append(w)
        lengths.append(np.diff(first))
        i = j
    return (np.concatenate(parts), np.concatenate(lengths)) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The written index of all documents, one row per block."""
    docs = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    schema = T.StructType([T.StructField("ids", T.ArrayType(docs.schema["id"].dataType)), *[T.StructField(c, t) for c, t in INDEX]])

    def block(data, offsets, tables):
        w, lengths = _terms(data, offsets, tables)
        order = np.argsort(w, kind="stable")
        w, doc = w[order], np.repeat(np.arange(len(lengths), dtype=np.uint16), lengths)[order]
        # Stable: equal terms stay in the order of documents, so equal (term, document) are neighbours.
        new_term = np.ones(len(w), dtype=bool)
        new_term[1:] = w[1:] != w[:-1]
        new = new_term.copy()
        new[1:] |= doc[1:] != doc[:-1]
        at = np.flatnonzero(new)
        counts = np.diff(at, append=len(w)).astype(np.uint32)
        sizes = np.add.reduceat(new, np.flatnonzero(new_term)) if len(w) else np.zeros(0)
        cells = [lengths.astype(np.int64), w[new_term], sizes.astype(np.uint32), doc[at], counts]
        return [*[x.tobytes() for x in cells], int((lengths > 0).sum()), len(w)]

    def run(batches):
        arrow, tables = to_arrow_schema(schema), _term_tables()
        for batch in batches:
            _, offsets = text_buffers(batch.column("text"))
            i, n = 0, batch.num_rows
            while i < n:
                j = int(np.searchsorted(offsets, offsets[i] + BLOCK_BYTES, side="right")) - 1
                j = min(max(i + 1, j), i + BLOCK_DOCS, n)
                # In the order of ids: of equal scores a block's earlier document is the better one.
                part = batch.slice(i, j - i)
                part = part.take(pc.sort_indices(part.column("id")))
                ids = pa.ListArray.from_arrays(pa.array([0, j - i], pa.int32()), part.column("id").cast(arrow.field("ids").type.value_type), type=arrow.field("ids").type)
                yield pa.RecordBatch.from_arrays([ids, *[pa.array([x], f.type) for x, f in zip(block(*text_buffers(part.column("text")), tables), list(arrow)[1:])]], schema=arrow)
                i = j

    return base.kept(docs.mapInArrow(run, schema), "search-index")


def _frequencies(index: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """Documents holding each searched term."""
    schema = T.StructType([T.StructField("term", T.IntegerType()), T.StructField("df", T.LongType())])

    def run(batches):
        total = np.zeros(len(vocabulary), dtype=np.int64)
        for batch in batches:
            for terms, sizes in zip(batch.column("terms"), batch.column("sizes")):
                terms, sizes = np.frombuffer(terms.as_buffer(), np.uint64), np.frombuffer(sizes.as_buffer(), np.uint32)
                at, there = _places(terms, vocabulary)
                total[there] += sizes[at]
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found])], schema=to_arrow_schema(schema))

    out = np.zeros(len(vocabulary), dtype=np.int64)
    # At most one row per searched term, whose number the batch of items bounds.
    rows = index.select("terms", "sizes").mapInArrow(run, schema).groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    out[rows["term"].to_numpy()] = rows["df"].to_numpy()
    return out


def _places(terms: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the searched terms are among a block's sorted terms, and which of them are there."""
    if not len(terms):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(terms, vocabulary), len(terms) - 1)
    there = np.flatnonzero(terms[at] == vocabulary)
    return at[there], there


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one behind the other."""
    total = np.cumsum(size)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(start - (total - size), size)


class _Block:
    """A block's lists of the searched terms, with what each document adds to a score."""

    def __init__(self, row: dict, vocabulary: np.ndarray, weight: np.ndarray, n_docs: int, n_terms: int):
        read = lambda c, t: np.frombuffer(row[c].as_buffer(), t)
        lengths = read("lengths", np.int64)
        at, there = _places(read("terms", np.uint64), vocabulary)
        sizes = read("sizes", np.uint32).astype(np.int64)
        start = np.cumsum(sizes) - sizes
        self.size = len(lengths)
        place = _ranges(start[at], sizes[at])
        self.doc = read("docs", np.uint16)[place].astype(np.int64)
        tf = read("counts", np.uint32)[place].astype(np.int64)
        m = 75 + (25 * lengths * n_docs) // n_terms
        adds = np.repeat(weight[there], sizes[at]) * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[self.doc]))
        self.adds, self.length = adds, sizes[at]
        self.start = np.cumsum(self.length) - self.length
        is_long = self.length * SHARE > self.size
        #: For each searched term its list here or -1; long lists have a row of their own.
        self.list_of = np.full(len(vocabulary), -1)
        self.list_of[there] = np.arange(len(there))
        self.row_of = np.where(is_long, np.cumsum(is_long) - 1, -1)
        self.whole = np.zeros((int(is_long.sum()), self.size), dtype=np.int64)
        own = np.repeat(self.row_of, self.length)
        self.whole[own[own >= 0], self.doc[own >= 0]] = adds[own >= 0]
        self.window = np.arange(0, self.size, WINDOW)
        self.most = np.maximum.reduceat(self.whole, self.window, axis=1) if len(self.whole) else np.zeros((0, len(self.window)), np.int64)

    def search(self, terms: np.ndarray, times: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the block's k best of at least ``least``, best first, earlier
        documents first among equals."""
        lists = self.list_of[terms]
        lists, times = lists[lists >= 0], times[lists >= 0]
        rows = self.row_of[lists]
        short, tall = lists[rows < 0], rows[rows >= 0]
        # Term by term: the sums of the short lists.
        sums = np.zeros(self.size, dtype=np.int64)
        place = _ranges(self.start[short], self.length[short])
        np.add.at(sums, self.doc[place], self.adds[place] * np.repeat(times[rows < 0], self.length[short]))
        seen = sums[sums > 0]
        if len(seen) >= k:
            least = max(least, int(np.partition(seen, -k)[-k]))
        # Document by document: the sums beside the long lists, each with its bounds.
        times = times[rows >= 0]
        bound = times @ self.most[tall]
        waiting = np.flatnonzero(bound + np.maximum.reduceat(sums, self.window) >= least)
        docs, scores, step = np.zeros(0, np.int64), np.zeros(0, np.int64), FIRST
        while len(waiting):
            now, waiting, step = waiting[:step], waiting[step:], 2 * step
            visit = (now[:, None] * WINDOW + np.arange(WINDOW)).ravel()
            visit = visit[visit < self.size]
            visit = visit[sums[visit] + bound[visit // WINDOW] >= least]
            score = sums[visit] + times @ self.whole[np.ix_(tall, visit)]
            docs, scores = np.concatenate([docs, visit[score >= least]]), np.concatenate([scores, score[score >= least]])
            if len(docs) > k:
                best = np.lexsort((docs, -scores))[:k]
                docs, scores = docs[best], scores[best]
            if len(docs) == k:
                least = max(least, int(scores.min()))
                waiting = waiting[bound[waiting] + np.maximum.reduceat(sums, self.window)[waiting] >= least]
        best = np.lexsort((docs, -scores))
        return docs[best], scores[best]


def _items(items: DataFrame, item_id: str, text: str):
    """Batches of different items with terms: ids, number of equal rows, and their terms."""
    items = base.kept(items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).filter("text IS NOT NULL").groupBy("item_id", "text").agg(F.count("*").alias("copies")), "search-items")
    total = items.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    batches = -(-total // ITEM_BYTES)
    for b in range(batches):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(batches)) == b) if batches > 1 else items
        table = rows.orderBy("item_id", "text").toArrow().combine_chunks()
        if table.num_rows:
            column = table["text"].chunk(0) if isinstance(table["text"], pa.ChunkedArray) else table["text"]
            w, lengths = _terms(*text_buffers(column), _term_tables())
            yield b, table, w, lengths


def search(index: DataFrame, items: DataFrame, k: int = 20, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """The k best documents of every item: item_id, rank (from 1), doc_id, score."""
    spark = index.sparkSession
    id_type, item_type = index.schema["ids"].dataType.elementType, items.schema[item_id].dataType
    n_docs, n_terms = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    found = spark.createDataFrame([], T.StructType([T.StructField("query", T.LongType()), T.StructField("item_id", item_type), T.StructField("copies", T.LongType()), T.StructField("doc_id", id_type), T.StructField("score", T.LongType())]))
    schema = found.schema
    for number, table, w, lengths in _items(items, item_id, text) if n_terms else ():
        vocabulary, term = np.unique(w, return_inverse=True)
        df = _frequencies(index, vocabulary)
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], dtype=np.int64)
        of = [np.unique(x, return_counts=True) for x in np.split(term, np.cumsum(lengths)[:-1])]
        shared = spark.sparkContext.broadcast((vocabulary, weight, of, table["item_id"].combine_chunks(), table["copies"].combine_chunks()))
        found = found.unionByName(index.mapInArrow(_searcher(schema, shared, number, n_docs, n_terms, k), schema))
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    best = found.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(GROUPS)))
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("query", "part").orderBy(*order))).filter(F.col("rank") <= k)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).filter(F.col("rank") <= k)
    return best.select("item_id", "rank", "doc_id", "score", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).drop("copy")


def _searcher(schema: T.StructType, shared, number: int, n_docs: int, n_terms: int, k: int):
    """A function over blocks that gives each item's best documents of each block."""

    def run(batches):
        arrow = to_arrow_schema(schema)
        vocabulary, weight, of, item_ids, copies = shared.value
        # The k best scores of each item in this task so far.
        tops = [np.zeros(k, dtype=np.int64) for _ in of]
        for batch in batches:
            for i in range(batch.num_rows):
                block = _Block({c: batch.column(c)[i] for c in ("lengths", "terms", "sizes", "docs", "counts")}, vocabulary, weight, n_docs, n_terms)
                ids = batch.column("ids")[i].values
                query, docs, scores = [], [], []
                for q, (terms, times) in enumerate(of):
                    d, s = block.search(terms, times, k, max(1, int(tops[q][0])))
                    if len(d):
                        tops[q] = np.sort(np.concatenate([tops[q], s]))[-k:]
                        query.append(np.full(len(d), q))
                        docs.append(d)
                        scores.append(s)
                if query:
                    query = np.concatenate(query)
                    cells = [pa.array(query + (number << 32)), item_ids.take(pa.array(query)), copies.take(pa.array(query)), ids.take(pa.array(np.concatenate(docs))), pa.array(np.concatenate(scores))]
                    yield pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(cells, arrow)], schema=arrow)

    return run


def ranked(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """The k best documents of every item, over an index built for it."""
    return search(build_index(docs), items, k)
