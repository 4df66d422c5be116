"""SentencePiece encoding and decoding that keep every piece's place in the original bytes.

A text is first normalised: at each place the longest key of the model's compiled character map is
replaced by its value, any other character stays, and every character written remembers the byte
its source begins at. The normalised text is then merged, pair by pair, best piece first and
leftmost on ties; what no piece covers becomes one piece per byte. Adding up the pieces' lengths
and looking the sums up among the remembered bytes gives each piece's span in the original text.

No piece of the usual models goes on behind a white space mark that follows another character, so
merges never cross the border in front of such a mark; the text is cut there, and what a part was
merged into is kept for its next occurrence (in two tables of fixed size, of which the older one is
forgotten). Parts that are new are merged side by side, a row of numbers each, long ones one by one. A
model with other pieces takes the text as one part.

The model's bytes are read where the driver runs and go out with the tasks. Supported are models of
type BPE with byte fallback; others are refused.

Defined results: null is an empty text; an empty text has the end id only, and decodes to an empty
text; ids and texts of repeated rows are those of any other row; an empty table gives an empty table;
other columns are not read. In ``decode`` null ids give an empty text, an id outside the model an error.
"""

from __future__ import annotations

import heapq
import re
import struct
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from demandtide.llm.hashing import chunks, text_buffers

# Fixed values of the model's format: the white space mark, the kinds of pieces, the surface of the unknown.
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2
UNKNOWN_SURFACE = " ⁇ "

#: Characters of a part up to which it is merged side by side with others and remembered, and the rank of no pair.
FEW, NEVER = 64, 1 << 30
#: Parts merged side by side: few enough for a processor's cache.
ABREAST = 2048
#: Parts whose pieces each table remembers.
REMEMBERED = 1 << 18


def _fields(data: bytes):
    """Number and value of each field of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield key >> 3, data[at : at + size]
        at += size


class CharacterMap:
    """The compiled map: a double-array trie over UTF-8 bytes whose leaves point at strings."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.values = blob[4 + size :]
        # Bytes that begin a key; at all others the character stays.
        self.first = {b for b in range(1, 256) if self.units and self._child(0, b) is not None}

    def _child(self, node: int, byte: int) -> int | None:
        unit = self.units[node]
        node ^= ((unit >> 10) << ((unit & 512) >> 6)) ^ byte
        return node if self.units[node] & 0x800000FF == byte else None

    def longest(self, data: bytes, at: int) -> tuple[str, int] | None:
        """Value of the longest key at a place and the place behind the key."""
        node, found = 0, None
        while at < len(data) and (node := self._child(node, data[at])) is not None:
            at += 1
            unit = self.units[node]
            if unit & 256:
                leaf = self.units[node ^ ((unit >> 10) << ((unit & 512) >> 6))]
                found = leaf & 0x7FFFFFFF, at
        if found is None:
            return None
        start = found[0]
        return self.values[start : self.values.index(b"\0", start)].decode(), found[1]


class Model:
    """Pieces and rules of a model file."""

    def __init__(self, data: bytes):
        self.pieces, scores, self.kinds = [], [], []
        trainer, normalizer = {}, {}
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normalizer = dict(_fields(value))
        byte_ids = [i for i, k in enumerate(self.kinds) if k == BYTE]
        if trainer.get(3, 1) != BPE or len(byte_ids) != 256 or not set(self.kinds) <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("not a BPE model with byte fallback, or one with user-defined or unused pieces")
        self.byte_id = {int(self.pieces[i][1:-1], 16): i for i in byte_ids}
        self.id_of = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == NORMAL}
        self.score = {p: scores[i] for p, i in self.id_of.items()}
        self.end = trainer.get(42, 2)
        self.suffix, self.dummy = bool(trainer.get(24, 0)), bool(normalizer.get(3, 1))
        self.trim, self.escape = bool(normalizer.get(4, 1)), bool(normalizer.get(5, 1))
        self.map = CharacterMap(normalizer.get(2, b""))
        self.plain = not self.map.units and not self.trim and self.escape and self.dummy and not self.suffix
        inner = any(MARK in p.lstrip(MARK) for p in self.id_of)
        self.parts = re.compile("(?s).+" if inner else f"{MARK}*[^{MARK}]+|{MARK}+")

    def surfaces(self) -> list[bytes]:
        """What each id decodes to."""
        shown = {NORMAL: lambda p: p.replace(MARK, " ").encode(), BYTE: lambda p: bytes([int(p[1:-1], 16)]), UNKNOWN: lambda p: UNKNOWN_SURFACE.encode(), CONTROL: lambda p: b""}
        return [shown[k](p) for p, k in zip(self.pieces, self.kinds)]

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its characters the byte its source begins at; one
        more at the end."""
        data = text.encode()
        if not data:
            return "", np.zeros(1, np.int32)
        if self.plain:
            starts = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
            return MARK + text.replace(" ", MARK), np.concatenate(([0], starts, [len(data)])).astype(np.int32)
        steps = []
        at = 0
        while at < len(data):
            found = self.map.longest(data, at) if data[at] in self.map.first else None
            if found is None:
                end = at + 1
                while end < len(data) and data[end] & 0xC0 == 0x80:
                    end += 1
                found = data[at:end].decode(), end
            steps.append((found[0], at))
            at = found[1]
        if self.trim:
            blanks = next((i for i, (s, _) in enumerate(steps) if s != " "), len(steps))
            steps = steps[blanks:]
        if not steps:
            return "", np.full(1, len(data), np.int32)
        out, source, blank = [], [], self.trim
        if self.dummy and not self.suffix:
            out.append(" ")
            source.append(steps[0][1])
        for s, begin in steps:
            s = s.lstrip(" ") if blank else s
            if s:
                out.extend(s)
                source.extend([begin] * len(s))
                blank = self.trim and s[-1] == " "
        end = len(data)
        while self.trim and out and out[-1] == " ":
            out.pop()
            end = source.pop()
        if self.dummy and self.suffix:
            out.append(" ")
            source.append(end)
        norm = "".join(out)
        return norm.replace(" ", MARK) if self.escape else norm, np.array([*source, end], np.int32)

    @cached_property
    def pairs(self) -> dict[str, bytes]:
        """Id and length of every piece."""
        return {p: struct.pack("=ii", i, len(p)) for p, i in self.id_of.items()}

    def pair_table(self) -> None:
        """Numbers of all symbols a piece is made of, and of all pairs of them that make a piece: the pair's
        rank, best first and equal scores alike, and the piece."""
        symbols = dict(self.id_of)
        for piece in self.id_of:
            for c in piece:
                symbols.setdefault(c, len(self.pieces) + len(symbols))
        # One number more, for all characters that no piece has.
        self.width = max(symbols.values(), default=0) + 2
        self.of_char = np.full(0x110000, self.width - 1, np.int32)
        for s, i in symbols.items():
            if len(s) == 1:
                self.of_char[ord(s)] = i
        _, rank = np.unique([-self.score[p] for p in self.id_of], return_inverse=True)
        made = [(symbols[p[:i]] * self.width + symbols[p[i:]], r, self.id_of[p]) for p, r in zip(self.id_of, rank.tolist()) for i in range(1, len(p)) if p[:i] in symbols and p[i:] in symbols]
        table = np.array(sorted(made), np.int64).reshape(-1, 3)
        self.pair = np.append(table[:, 0], np.iinfo(np.int64).max)
        self.rank, self.into = (np.append(table[:, k], x).astype(np.int32) for k, x in ((1, NEVER), (2, -1)))

    def _look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of each pair of symbols; ``NEVER`` where they make none."""
        key = np.where(left >= 0, left.astype(np.int64) * self.width, -self.width) + right
        at = np.searchsorted(self.pair, key)
        there = (self.pair[at] == key) & (right >= 0)
        return np.where(there, self.rank[at], np.int32(NEVER)), self.into[at]

    def encoded_many(self, parts: list[str]) -> list[bytes]:
        """``encoded`` of many parts at once: all of them take their best pair, step by step, a row each.
        Needs the table of pairs."""
        out: list[bytes | None] = [None] * len(parts)
        sizes = np.array([len(p) for p in parts])
        for low, high in zip((0, 8, 16, 32), (8, 16, 32, FEW)):
            rows = np.flatnonzero((sizes > low) & (sizes <= high))
            for at in range(0, len(rows), ABREAST):
                self._rows(parts, sizes[rows[at : at + ABREAST]], rows[at : at + ABREAST], out)
        return [x if x is not None else self.encoded(p) for x, p in zip(out, parts)]

    def _rows(self, parts: list[str], sizes: np.ndarray, row: np.ndarray, out: list) -> None:
        """Sets ``out`` at the places ``row``."""
        width = int(sizes.max())
        column = np.arange(width + 1)
        symbol = np.full((len(row), width + 1), -1, np.int32)
        symbol[column < sizes[:, None]] = self.of_char[np.frombuffer("".join([parts[i] for i in row]).encode("utf-32-le"), np.uint32)]
        begin = np.minimum(column, sizes[:, None]).astype(np.int32)
        rank, into = self._look(symbol[:, :-1], symbol[:, 1:])
        while len(row):
            best = rank.argmin(1)  # the first one of equals
            here = np.arange(len(row))
            done = rank[here, best] == NEVER
            self._finish(parts, symbol[done], begin[done], row[done], out)
            go = ~done
            symbol, begin, rank, into, row, best = symbol[go], begin[go], rank[go], into[go], row[go], best[go]
            here = np.arange(len(row))
            piece = into[here, best]
            # The symbols behind the pair move up by one.
            move = np.minimum(column + (column > best[:, None]), width)
            symbol, begin = np.take_along_axis(symbol, move, 1), np.take_along_axis(begin, move, 1)
            symbol[:, -1] = -1
            symbol[here, best] = piece
            move = np.minimum(move[:, :-1], width - 1)
            rank, into = np.take_along_axis(rank, move, 1), np.take_along_axis(into, move, 1)
            rank[:, -1] = NEVER
            for at in (np.maximum(best - 1, 0), best):
                at = np.minimum(at, width - 1)
                rank[here, at], into[here, at] = self._look(symbol[here, at], symbol[here, at + 1])

    def _finish(self, parts: list[str], symbol: np.ndarray, begin: np.ndarray, row: np.ndarray, out: list) -> None:
        """Ids and lengths of rows that merge no further, as one run of bytes cut row by row; symbols that
        are no piece, single characters, go byte by byte."""
        mask = symbol[:, :-1] >= 0
        cells = np.stack([symbol[:, :-1][mask], np.diff(begin)[mask]], 1).astype(np.int32).tobytes()
        ends = (8 * np.cumsum(mask.sum(1))).tolist()
        pieces_only = (symbol < len(self.pieces)).all(1).tolist()
        start = 0
        for k, (i, end, whole) in enumerate(zip(row.tolist(), ends, pieces_only)):
            out[i] = cells[start:end]
            if not whole:
                marks = [(a, b, s < len(self.pieces)) for a, b, s in zip(begin[k].tolist(), begin[k, 1:].tolist(), symbol[k].tolist()) if s >= 0]
                out[i] = b"".join([cells[start + 8 * j : start + 8 * j + 8] if known else self._by_bytes(parts[i][a:b]) for j, (a, b, known) in enumerate(marks)])
            start = end

    def merge(self, part: str) -> list[str]:
        """The symbols left when no two neighbours make a piece, for a part of any length: pairs in a heap."""
        n = len(part)
        symbol, after, before = list(part), list(range(1, n + 1)), list(range(-1, n - 1))
        waiting: list = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < n:
                both = symbol[i] + symbol[after[i]]
                score = self.score.get(both)
                if score is not None:
                    heapq.heappush(waiting, (-score, i, both))

        for i in range(n - 1):
            offer(i)
        while waiting:
            _, i, both = heapq.heappop(waiting)
            j = after[i]
            # Taken up by another merge meanwhile.
            if not symbol[i] or j >= n or len(symbol[i]) + len(symbol[j]) != len(both):
                continue
            symbol[i], symbol[j] = both, ""
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [s for s in symbol if s]

    def encoded(self, part: str) -> bytes:
        """Pairs of id and length in characters of a part's pieces."""
        pairs = self.pairs
        return b"".join([pairs.get(s) or self._by_bytes(s) for s in self.merge(part)])

    def _by_bytes(self, character: str) -> bytes:
        """A character without a piece: only the last of its bytes has its length."""
        ids = [self.byte_id[b] for b in character.encode()]
        return b"".join([struct.pack("=ii", i, k == len(ids)) for k, i in enumerate(ids, 1)])


def read_model(path: str) -> bytes:
    """A model file's bytes, read by the driver."""
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, model: bytes, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, ids (the end id last), starts and ends (each piece's bytes in
    the original text, the end behind the last one)."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    numbers = T.ArrayType(T.IntegerType(), False)
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *[T.StructField(c, numbers, False) for c in ("ids", "starts", "ends")]])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        arrow, rules, known, older = to_arrow_schema(schema), Model(shared.value), {}, {}
        end = np.array([rules.end, 0], np.int32).tobytes()
        rules.pair_table()

        def learn(lists: list[list[str]]) -> dict[str, bytes]:
            """Every part's pieces: those not met lately are merged together."""
            nonlocal known, older
            if len(known) >= REMEMBERED:
                known, older = {}, known
            new = set().union(*lists) - known.keys()
            for part in [p for p in new if p in older]:
                known[part] = older[part]
                new.discard(part)
            few = [p for p in new if len(p) <= FEW]
            known.update(zip(few, rules.encoded_many(few)))
            return {p: rules.encoded(p) for p in new if len(p) > FEW}

        for batch in batches:
            column = batch.column("text")
            _, offsets = text_buffers(column)
            for lo, hi in chunks(offsets):
                sizes, ids, starts, ends = [0], [], [], []
                normal = [rules.normalise(x or "") for x in column.slice(lo, hi - lo).to_pylist()]
                lists = [rules.parts.findall(norm) for norm, _ in normal]
                long = learn(lists)
                for parts, (_, source) in zip(lists, normal):
                    pairs = np.frombuffer(b"".join([known.get(p) or long[p] for p in parts]) + end, np.int32).reshape(-1, 2)
                    behind = np.cumsum(pairs[:, 1])
                    sizes.append(len(pairs))
                    ids.append(pairs[:, 0])
                    starts.append(source[behind - pairs[:, 1]])
                    ends.append(source[behind])
                at = pa.array(np.cumsum(sizes), pa.int32())
                lists = [pa.ListArray.from_arrays(at, pa.array(np.concatenate(x), pa.int32()), type=arrow.field("ids").type) for x in (ids, starts, ends)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo).cast(arrow.field("doc_id").type), *lists], schema=arrow)

    return docs.mapInArrow(run, schema)


def decode(rows: DataFrame, model: bytes, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``rows`` without the column ``ids`` and with its text in the column ``out``."""
    others = [f for f in rows.schema.fields if f.name not in (ids, out)]
    schema = T.StructType([*others, T.StructField(out, T.StringType(), False)])
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def text_of(pieces: bytes) -> str:
        try:
            return pieces.decode()
        except UnicodeDecodeError:
            # Each byte that is part of no character is shown as one replacement character.
            kept, at = [], 0
            while at < len(pieces):
                try:
                    kept.append(pieces[at:].decode())
                    break
                except UnicodeDecodeError as e:
                    kept.append(pieces[at : at + e.start].decode() + "�" * (e.end - e.start))
                    at += e.end
            return "".join(kept)

    def run(batches):
        arrow, rules = to_arrow_schema(schema), Model(shared.value)
        shown = rules.surfaces()
        # Behind them the same ones without their first byte, for a text's first piece.
        surfaces = pa.array([*shown, *[x[1:] for x in shown]], pa.binary())
        marked = np.array([k == NORMAL and p.startswith(MARK) for p, k in zip(rules.pieces, rules.kinds)])
        silent = np.array([k == CONTROL for k in rules.kinds])
        for batch in batches:
            column = batch.column(ids)
            if column.null_count:
                column = pa.array([x or [] for x in column.to_pylist()], column.type)
            at = column.offsets.to_numpy() - (column.offsets[0].as_py() if len(column) else 0)
            flat = column.flatten().to_numpy().copy()
            if len(flat) and not 0 <= flat.min() <= flat.max() < len(shown):
                raise ValueError("an id outside the model")
            if rules.dummy and not rules.suffix:
                # The first piece that shows anything loses the mark put in front of the text.
                seen = np.flatnonzero(~silent[flat])
                first = np.searchsorted(seen, at[:-1])
                first = seen[first[first < np.searchsorted(seen, at[1:])]]
                flat[first[marked[flat[first]]]] += len(shown)
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(at, pa.int32()), surfaces.take(pa.array(flat))), b"")
            try:
                texts = joined.cast(arrow.field(out).type)
            except pa.ArrowInvalid:
                texts = pa.array([text_of(x) for x in joined.to_pylist()], arrow.field(out).type)
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name).cast(arrow.field(f.name).type) for f in others], texts], schema=arrow)

    return rows.mapInArrow(run, schema)
