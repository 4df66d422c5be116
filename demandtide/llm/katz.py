"""Katz back-off model of any order: Good-Turing discounted counts, exactly normalised back-off weights.

Counts come from the training documents (crc32 of the id as text, modulo 5, not 1); every document is
scored. ``P(w|h) = d(c) c / c(h)`` for an n-gram seen ``c`` times, else ``alpha(h) P(w|h')``, where ``h'`` is the
history without its first word, and so on down to the discounted unigrams, whose freed mass an unseen
word takes. ``alpha(h) = (1 - sum of discounted P(w|h)) / (1 - sum of P(w|h'))`` over the words seen after
``h``, so each history's probabilities add up to one. The first words of a text have shorter histories;
one start mark stands before the first.

How the work is dealt out: documents become *blocks* of at most ``BLOCK_TOKENS`` tokens, coded as numbers
and written to the shared folder under a name made of their content. Level by level, a block asks the
owners of its n-grams (buckets of the history's hash) for global counts and sends along what the level
below says of each. An owner merges what all blocks sent, which is the partitioned table of that
level, and answers each block in the order it asked; with the answers the block has the probabilities of
all its n-grams of the level and asks for the next. So neither counts nor tokens of the whole corpus
meet anywhere, and an n-gram travels at most once per block and level, not once per token: an owner also
says which n-grams no other block has, and what follows such a history, or one that no training document
has, is counted in the block itself. A history of more than ``HOT`` tokens has several owners, dealt by the
following word; their sums meet per history.

The owners of words number them by rank; with these numbers n-grams travel and are compared, sorted and
as steps, the histories as the numbers of their words. Of the level below only counts travel, and back come
only whole numbers: how many words free mass, and how often those seen occur on the level below. From these a
block has the sum of their probabilities. What is answered is kept once, a file for each block and level: the
table of answers and all shuffle files of a level go before the blocks ask for the next. So do the words'
hashes, once the words have numbers.

Words and the names of histories are 64-bit hashes; the number of a following word has 48 bits. Counts have 64 bits.

Defined results: a null or empty text is one token, the end; a null id counts as the text "" for the fold;
rows that repeat an id are scored each; no training document: scores rest on unseen words alone;
an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
import io
import json
import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from demandtide.llm.hashing import Tables, chunks, mix, text_buffers, word_hashes
from demandtide.session import scratch_dir

BLOCK_TOKENS = 1 << 21
#: Tokens of a history from which it has several owners.
HOT = 1 << 20
#: Buckets of words and histories for each task that reads documents.
BUCKETS_PER_TASK = 4
#: Counts up to which Good-Turing discounts apply.
LARGEST = 5
#: Numbers told of a history: of words seen 1..LARGEST times after it, of seen words with such counts on the
#: level below, and the other seen words' counts there.
TOLD = 2 * LARGEST + 1
START, END = np.uint64(1), np.uint64(2)
#: Spark's switch for deleting a query's shuffle files at its end.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Where blocks lie until their words have numbers.
UNNUMBERED = "unnumbered"
#: The bucket of blocks that have nothing to ask.
NOBODY = -1

ASK = "block long, bucket int, words binary, counts binary, lower binary, runs binary, histories binary, n long, v long, ofs array<double>"
ANSWER = "kind string, block long, bucket int, counts binary, stats binary, alone binary, ranks binary, n long, v long, history long, ofs array<double>"


def _narrow(x: np.ndarray) -> np.ndarray:
    """The same numbers in the fewest bytes that hold them; fractions stay as they are."""
    if not len(x):
        return x
    low, high = x.min(), x.max()
    if x.dtype.kind == "f" and not (low >= 0 and high < 2**32 and (x == np.floor(x)).all()) or low < 0:
        return x
    return x.astype(np.min_scalar_type(int(high)))


def _pack(x: np.ndarray) -> bytes:
    """Column by column, byte by byte of the numbers: equal bytes come together."""
    columns = [_narrow(c) for c in (x.T if x.ndim == 2 else [x])]
    body = b"".join(c.view(np.uint8).reshape(len(c), c.itemsize).T.tobytes() for c in map(np.ascontiguousarray, columns))
    head = json.dumps([x.dtype.str, len(x), len(body), [c.dtype.str for c in columns]]).encode()
    return struct.pack("<H", len(head)) + head + (pa.compress(body, codec="zstd", asbytes=True) if body else b"")


def _unpack(b: bytes | np.ndarray, kind=None) -> np.ndarray:
    """What was packed, flat, as ``kind`` or as it was."""
    if isinstance(b, np.ndarray):
        return b
    (size,) = struct.unpack_from("<H", b)
    was, rows, length, kinds = json.loads(b[2 : 2 + size])
    body = np.frombuffer(pa.decompress(b[2 + size :], decompressed_size=length, codec="zstd", asbytes=True) if length else b"", np.uint8)
    out, at = np.empty((rows, len(kinds)), kind or was), 0
    for i, k in enumerate(map(np.dtype, kinds)):
        planes = body[at : at + rows * k.itemsize].reshape(k.itemsize, rows)
        out[:, i] = np.ascontiguousarray(planes.T).view(k).ravel()
        at += rows * k.itemsize
    return out.ravel()


def _bits(x: np.ndarray) -> bytes:
    return _pack(np.packbits(x))


def _unbits(b: bytes, size: int) -> np.ndarray:
    return np.unpackbits(_unpack(b, np.uint8), count=size).astype(bool)


def _steps(x: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Differences of numbers that rise within runs; the first of a run stays (``start`` marks them)."""
    out = x.copy()
    out[1:] -= x[:-1]
    out[start] = x[start]
    return out


def _risen(steps: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The numbers of ``_steps``."""
    total, at = np.cumsum(steps), np.flatnonzero(start)
    return total - np.repeat(total[at] - steps[at], np.diff(np.append(at, len(steps))))


def _distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different numbers (none negative) and each element's place among them."""
    low = len(x).bit_length()
    if not len(x) or int(x.max()).bit_length() + low > 64:
        return np.unique(x, return_inverse=True)
    # Numbers and positions sorted as one are faster than positions by number.
    both = np.sort(x.astype(np.uint64) << np.uint64(low) | np.arange(len(x), dtype=np.uint64))
    number, at = both >> np.uint64(low), (both & np.uint64((1 << low) - 1)).astype(np.int64)
    new = np.concatenate(([True], number[1:] != number[:-1]))
    place = np.empty(len(x), np.int64)
    place[at] = np.cumsum(new) - 1
    return number[new].astype(x.dtype), place


def discounts(n: np.ndarray) -> np.ndarray:
    """Factor of counts 0..LARGEST from the numbers ``n[r]`` of types that occur r times
    (r up to LARGEST + 1); 1 where the counts do not support a discount."""
    d = np.ones(LARGEST + 1)
    if n[1] == 0:
        return d
    cut = (LARGEST + 1) * n[LARGEST + 1] / n[1]
    for r in range(1, LARGEST + 1):
        if n[r] and cut < 1:
            x = ((r + 1) * n[r + 1] / (r * n[r]) - cut) / (1 - cut)
            if 0 < x < 1:
                d[r] = x
    return d


class Unigrams:
    """P(w) from a word's count: discounted, the freed mass goes to the unseen word."""

    def __init__(self, tokens: int, types: int, n: np.ndarray) -> None:
        self.tokens, self.types, self.d = tokens, types, discounts(n)
        freed = sum(r * n[r] * (1 - self.d[r]) for r in range(1, LARGEST + 1)) / tokens if tokens else 1.0
        # Nothing freed: the unseen word counts as one more token.
        self.unseen = freed if freed > 0 else 1.0 / (tokens + 1)
        self.scale = 1.0 if freed > 0 else tokens / (tokens + 1)

    def __call__(self, c: np.ndarray) -> np.ndarray:
        d = np.where(c <= LARGEST, self.d[np.minimum(c, LARGEST)], 1.0)
        return np.where(c > 0, d * c * self.scale / max(self.tokens, 1), self.unseen)


def _save(folder: str, name: str, **arrays) -> None:
    """Written under an attempt's name, then renamed: a task run again replaces its own file."""
    fs, root = pafs.FileSystem.from_uri(folder)
    fs.create_dir(root, recursive=True)
    attempt = f"{root}/{name}.{TaskContext.get().taskAttemptId()}"
    data = io.BytesIO()
    np.savez(data, **{k: np.frombuffer(_pack(x), np.uint8) for k, x in arrays.items()})
    with fs.open_output_stream(attempt) as out:
        out.write(data.getvalue())
    fs.move(attempt, f"{root}/{name}")


def _load(folder: str, name: str) -> dict[str, np.ndarray]:
    fs, root = pafs.FileSystem.from_uri(folder)
    with fs.open_input_file(f"{root}/{name}") as file:
        return {k: _unpack(x.tobytes()) for k, x in np.load(io.BytesIO(file.read())).items()}


def _held(ids: list) -> np.ndarray:
    return np.array([zlib.crc32(("" if x is None else str(x)).encode()) % 5 == 1 for x in ids], dtype=bool)


def _segments(bucket: np.ndarray):
    edge = np.flatnonzero(np.diff(bucket)) + 1
    return zip(np.concatenate(([0], edge)), np.concatenate((edge, [len(bucket)]))) if len(bucket) else ()


def _ask_words(docs: DataFrame, folder: str, buckets: int) -> DataFrame:
    """Writes blocks; asks for the counts of their words."""

    def block_of(number: int, rows: list) -> pa.RecordBatch:
        held = _held([r[0] for r in rows])
        length = np.array([len(r[1]) + 1 for r in rows])
        tokens = np.concatenate([x for r in rows for x in (r[1], [END])]).astype(np.uint64)
        words, ids = _distinct(np.concatenate(([START], tokens)))
        train = np.repeat(~held, length)
        counts = np.bincount(ids[1:][train], minlength=len(words))
        counts[ids[0]] = (~held).sum()
        # A task that runs again over rows in another order writes other files and asks for those.
        content = hashlib.blake2b(b"".join(x.tobytes() for x in (words, ids, length, held)), digest_size=8, key=b"%d/%d" % (TaskContext.get().partitionId(), number))
        block = int.from_bytes(content.digest()) >> 1
        # In the file the block's frequent words have the small numbers; of the words it has the order only.
        often = np.argsort(-np.bincount(ids), kind="stable")
        number = np.empty_like(often)
        number[often] = np.arange(len(often))
        doc = np.frombuffer(json.dumps([r[0] for r in rows]).encode(), np.uint8)
        _save(f"{folder}/{UNNUMBERED}", f"block-{block}", words=often, ids=number[ids[1:]], length=length, held=held.astype(np.uint8), doc=doc)
        bucket = (words >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
        out = [(block, int(bucket[a]), words[a:z].tobytes(), _pack(counts[a:z].astype(np.int64))) for a, z in _segments(bucket)]
        return pd.DataFrame(out, columns=["block", "bucket", "words", "counts"]).assign(lower=b"", runs=b"", histories=b"", n=None, v=None, ofs=None)

    def run(batches):
        tables, rows, held, number = Tables(), [], 0, 0
        for batch in batches:
            ids = batch.column("id").to_pylist()
            data, offsets = text_buffers(batch.column("text"))
            for i, j in chunks(offsets):
                w, first = word_hashes(data, offsets[i : j + 1], tables)
                w = np.maximum(w, np.uint64(3))
                for k in range(j - i):
                    rows.append((ids[i + k], w[first[k] : first[k + 1]]))
                    held += int(first[k + 1] - first[k]) + 1
                if held >= BLOCK_TOKENS:
                    yield from _batches(block_of(number, rows))
                    rows, held, number = [], 0, number + 1
        if rows:
            yield from _batches(block_of(number, rows))

    schema = T._parse_datatype_string(ASK)
    arrow = to_arrow_schema(schema)

    def _batches(pdf):
        yield pa.RecordBatch.from_pandas(pdf, schema=arrow, preserve_index=False)

    return docs.mapInArrow(run, schema)


def _frame(rows: list[dict]) -> pd.DataFrame:
    columns = ["kind", "block", "bucket", "counts", "stats", "alone", "ranks", "n", "v", "history", "ofs"]
    whole = ("block", "bucket", "n", "v", "history")
    return pd.DataFrame({c: pd.array([r.get(c) for r in rows], dtype="Int64") if c in whole else pd.Series([r.get(c) for r in rows], dtype=object) for c in columns})


def _count_words(pdf: pd.DataFrame) -> pd.DataFrame:
    """Owner of words: merges, answers each block, adds the totals. Words get their rank by count."""
    pdf = pdf.sort_values("block")
    words = [np.frombuffer(x, np.uint64) for x in pdf["words"]]
    counts = np.concatenate([_unpack(x, np.int64) for x in pdf["counts"]])
    types, place = np.unique(np.concatenate(words), return_inverse=True)
    alone = np.bincount(place) == 1
    total = _sums(place, counts, len(types))
    rank = np.empty(len(types), np.int64)
    rank[np.argsort(-total, kind="stable")] = np.arange(len(types))
    true = types != START
    n = np.bincount(np.minimum(total[true], LARGEST + 2), minlength=LARGEST + 3)[: LARGEST + 2]
    rows = [{"kind": "total", "n": int(total[true].sum()), "v": int((total[true] > 0).sum()), "ofs": n.astype(float).tolist()}]
    at = 0
    for block, bucket, w in zip(pdf["block"], pdf["bucket"], words):
        mine = place[at : at + len(w)]
        rows.append({"kind": "answer", "block": block, "bucket": bucket, "counts": _pack(total[mine]), "alone": _bits(alone[mine]), "ranks": _pack(rank[mine])})
        at += len(w)
    return _frame(rows)


def _sums(place: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """Whole sums per place, exact beyond the 53 bits of a weight."""
    out = np.zeros(size, dtype=np.int64)
    np.add.at(out, place, counts)
    return out


@dataclass
class _Level:
    """A block's different n-grams of one length, in the order of (history, word)."""

    at: np.ndarray  # each token's n-gram, -1 where the text has no history of that length
    history: np.ndarray  # number of the history among the n-grams of the level below
    word: np.ndarray
    lower: np.ndarray  # number of the n-gram without its first word on the level below
    train: np.ndarray  # occurrences in the block's training documents
    hash: np.ndarray


def _first(block) -> np.ndarray:
    """First token of each document."""
    return np.concatenate(([0], np.cumsum(block["length"])[:-1]))


def _levels(block, order: int, number: np.ndarray) -> list[_Level]:
    """The n-grams of a block up to ``order``; those of one word are the block's words. ``number``
    has each word's number in all blocks."""
    ids, words, first = block["ids"], block["words"], _first(block)
    train = np.repeat(block["held"] == 0, block["length"])
    none = np.zeros(0, np.int64)
    out = [_Level(ids, none, np.arange(len(words)), none, none, _named(number[:, None]))]
    for k in range(2, order + 1):
        below = out[-1]
        before = np.concatenate(([-1], below.at[:-1]))
        before[first] = np.argmax(words == START) if k == 2 else -1
        there = before >= 0
        grams, place = _distinct(before[there] * len(words) + ids[there])
        at = np.full(len(ids), -1)
        at[there] = place
        history, word, lower = grams // len(words), grams % len(words), np.empty(len(grams), np.int64)
        lower[place] = below.at[there]
        # No histories are made of the longest.
        name = _longer(below.hash[history], number[word]) if k < order else none
        out.append(_Level(at, history, word, lower, np.bincount(place[train[there]], minlength=len(grams)), name))
    return out


def _longer(history: np.ndarray, number: np.ndarray) -> np.ndarray:
    return mix(history * np.uint64(0xD6E8FEB86659FD93) + number)


def _named(paths: np.ndarray) -> np.ndarray:
    """Names of the n-grams whose words' numbers are the rows of ``paths``."""
    name = mix(paths[:, 0] + np.uint64(1))
    for column in paths.T[1:]:
        name = _longer(name, column)
    return name


def _paths(levels: list[_Level], k: int, grams: np.ndarray, number: np.ndarray) -> np.ndarray:
    """The words' numbers of n-grams of level ``k``, a row for each."""
    columns = []
    for level in levels[k - 1 : 0 : -1]:
        columns.append(number[level.word[grams]])
        grams = level.history[grams]
    return np.stack([number[grams], *columns[::-1]], axis=1)


def _sent_paths(paths: np.ndarray) -> np.ndarray:
    """Paths in rising order as steps, column by column; a new word starts those of the next columns."""
    start, out = np.arange(len(paths)) == 0, []
    for column in paths.T:
        out.append(_steps(column, start))
        start[1:] |= column[1:] != column[:-1]
    return np.stack(out, axis=1)


def _read_paths(steps: np.ndarray) -> np.ndarray:
    start, out = np.arange(len(steps)) == 0, []
    for column in steps.T:
        out.append(_risen(column, start))
        start[1:] |= out[-1][1:] != out[-1][:-1]
    return np.stack(out, axis=1)


def _owners(history: np.ndarray, word: np.ndarray, count: np.ndarray, buckets: int) -> np.ndarray:
    parts = 1 + count // HOT
    which = mix(word) % parts.astype(np.uint64)
    return ((mix(history + which) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


@dataclass
class _State:
    """What is known of a block's n-grams of one length."""

    counts: np.ndarray
    p: np.ndarray
    alone: np.ndarray  # in no other block
    whole: np.ndarray  # tokens of the histories, as they count


def _dealt(levels: list[_Level], number: np.ndarray, k: int, below: _State, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of level ``k`` that other blocks may have, in the order in which they go to their owners,
    and these. A history that no other block has, or no training document, has nothing to learn there."""
    level = levels[k - 1]
    shared = np.flatnonzero((~below.alone & (below.counts > 0))[level.history])
    history = level.history[shared]
    bucket = _owners(levels[k - 2].hash[history], number[level.word[shared]], below.counts[history], buckets)
    order = np.argsort(bucket.astype(np.min_scalar_type(buckets)), kind="stable")
    return shared[order], bucket[order]


def _ask_grams(block_id: int, levels: list[_Level], number: np.ndarray, k: int, states: list[_State], buckets: int) -> pd.DataFrame:
    """A row per owner: runs of histories, the words after them, training counts, and the counts on the level
    below (of each word once on the lowest). The first row has the totals of the n-grams that go to no owner."""
    level, below = levels[k - 1], states[k - 2]
    order, bucket = _dealt(levels, number, k, below, buckets)
    rows = []
    for a, z in _segments(bucket):
        mine = order[a:z]
        hs, word, train, lower = level.history[mine], number[level.word[mine]], level.train[mine], level.lower[mine]
        edge = np.concatenate(([0], np.flatnonzero(np.diff(hs)) + 1, [len(hs)]))
        lead = hs[edge[:-1]]
        paths = _paths(levels, k - 1, lead, number)
        # Above, the sums over seen words take their terms from blocks that have seen them.
        told = below.counts[lower[np.unique(word, return_index=True)[1]] if k == 2 else lower[train > 0]]
        start = np.zeros(len(word), dtype=bool)
        start[edge[:-1]] = True
        names = np.column_stack((_sent_paths(paths), (below.counts[lead] >= HOT).astype(np.uint64)))
        rows.append((block_id, int(bucket[a]), _pack(_steps(word, start)), _pack(train), _pack(told), _pack(np.diff(edge)), _pack(names)))
    if not rows:
        # Nothing to ask at this level: the block stays in the round.
        rows.append((block_id, NOBODY, *[b""] * 5))
    own = level.train.copy()
    own[order] = 0
    n = np.bincount(np.minimum(own[own > 0], LARGEST + 2), minlength=LARGEST + 3)[: LARGEST + 2]
    out = pd.DataFrame(rows, columns=["block", "bucket", "words", "counts", "lower", "runs", "histories"])
    rest = [None] * (len(rows) - 1)
    for name, first in (("n", int(own.sum())), ("v", int((own > 0).sum()))):
        out[name] = pd.array([first, *rest], dtype="Int64")
    out["ofs"] = pd.Series([n.astype(float).tolist(), *rest], dtype=object)
    return out


def _factors(d: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.where(c <= LARGEST, d[np.minimum(c, LARGEST)], 1.0)


def _merge_grams(k: int):
    """Owner of histories of level ``k``: reads what blocks sent and answers; passes on the totals of what they kept."""

    def read(row) -> dict:
        steps, train, runs = _unpack(row["words"], np.uint64), _unpack(row["counts"], np.int64), _unpack(row["runs"], np.int64)
        start = np.zeros(len(steps), dtype=bool)
        start[np.cumsum(runs) - runs] = True
        word, histories = _risen(steps, start), _unpack(row["histories"], np.uint64).reshape(len(runs), k)
        paths, flags = _read_paths(histories[:, :-1]), histories[:, -1]
        c, lower = _unpack(row["lower"], np.int64), np.zeros(len(word), np.int64)
        seen = train > 0
        lower[seen] = c[np.unique(word, return_inverse=True)[1]][seen] if k == 2 else c
        low, high = word.astype(np.uint32), (word >> np.uint64(32)).astype(np.uint16)
        names = np.concatenate((_named(paths), flags))
        return {"block": row["block"], "bucket": row["bucket"], "words": low.tobytes() + high.tobytes(), "counts": train, "lower": lower, "runs": runs, "histories": names.tobytes()}

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        kept = pdf[pdf["ofs"].notna()]
        told = [{"kind": "total", "n": int(n), "v": int(v), "ofs": list(ofs)} for n, v, ofs in zip(kept["n"], kept["v"], kept["ofs"])]
        asked = pdf if pdf["bucket"].iloc[0] == NOBODY else pd.DataFrame([read(r) for r in pdf.to_dict("records")])
        return pd.concat([_count_grams(asked), _frame(told)], ignore_index=True)

    return run


def _brief(stats: np.ndarray, needed: np.ndarray) -> None:
    """The counts below, and how many words free mass rather than whether any does, matter only where the block
    has an n-gram to back off for."""
    stats[~needed, :LARGEST] = np.minimum(stats[~needed, :LARGEST], 1)
    stats[~needed, LARGEST:] = 0


def _count_grams(pdf: pd.DataFrame) -> pd.DataFrame:
    """Owner of histories: merges the n-grams, answers each block; per history what ``TOLD`` names, or,
    for one of several owners, its part of it."""
    pdf = pdf.sort_values("block")
    if pdf["bucket"].iloc[0] == NOBODY:
        return _frame([{"kind": "answer", "block": b, "bucket": NOBODY, "counts": _pack(np.zeros(0, np.int64)), "stats": _pack(np.zeros(0, np.int64)), "alone": _bits(np.zeros(0, bool))} for b in pdf["block"]])
    parts = []
    for w, c, x, r, h in zip(pdf["words"], pdf["counts"], pdf["lower"], pdf["runs"], pdf["histories"]):
        m = len(w) // 6
        word = np.frombuffer(w[: 4 * m], np.uint32).astype(np.uint64) | np.frombuffer(w[4 * m :], np.uint16).astype(np.uint64) << np.uint64(32)
        runs, both = _unpack(r, np.uint32), np.frombuffer(h, np.uint64)
        parts.append((word, _unpack(c, np.int64), _unpack(x, np.int64), both[: len(runs)], both[len(runs) :], runs))
    word, c, lower = (np.concatenate([p[k] for p in parts]) for k in range(3))
    names, of_run = np.unique(np.concatenate([p[3] for p in parts]), return_inverse=True)
    owner = np.repeat(of_run, np.concatenate([p[5] for p in parts]).astype(np.int64))
    bits = int(word.max()).bit_length()
    if bits + len(names).bit_length() <= 64:
        order = np.argsort(owner.astype(np.uint64) << np.uint64(bits) | word, kind="stable")
    else:
        order = np.lexsort((word, owner))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (word[order[1:]] != word[order[:-1]]) | (owner[order[1:]] != owner[order[:-1]])
    start = np.flatnonzero(new)
    alone = np.diff(np.append(start, len(order))) == 1
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    total = np.add.reduceat(c[order], start)
    below = np.maximum.reduceat(lower[order], start)
    seen = total > 0
    owner = owner[order[new]]
    stats = np.zeros((len(names), TOLD), np.int64)
    for first, c in ((0, total), (LARGEST, below)):
        few = np.flatnonzero(seen & (c > 0) & (c <= LARGEST))
        stats[:, first : first + LARGEST] = np.bincount(owner[few] * LARGEST + c[few] - 1, minlength=LARGEST * len(names)).reshape(-1, LARGEST)
    # The n-grams lie in the order of their histories.
    stats[:, -1] = np.add.reduceat(np.where(seen & (below > LARGEST), below, 0), np.searchsorted(owner, np.arange(len(names))))
    n = np.bincount(np.minimum(total[seen], LARGEST + 2), minlength=LARGEST + 3)[: LARGEST + 2]
    rows = [{"kind": "total", "n": int(total.sum()), "v": int(seen.sum()), "ofs": n.astype(float).tolist()}]
    at, run, hot = 0, 0, {}
    for block, bucket, p in zip(pdf["block"], pdf["bucket"], parts):
        m = len(p[0])
        mine, asked = of_run[run : run + len(p[3])], total[place[at : at + m]]
        told = stats[mine]
        _brief(told, np.logical_or.reduceat(asked == 0, np.cumsum(p[5], dtype=np.int64) - p[5].astype(np.int64)))
        rows.append({"kind": "answer", "block": block, "bucket": bucket, "counts": _pack(asked), "stats": _pack(told), "alone": _bits(alone[place[at : at + m]])})
        hot |= {int(k): int(i) for k, i, f in zip(p[3], mine, p[4]) if f}
        at, run = at + m, run + len(p[3])
    for k, i in hot.items():
        rows.append({"kind": "part", "history": int(np.uint64(k).view(np.int64)), "ofs": stats[i].astype(float).tolist()})
    return _frame(rows)


def _words_told(folder: str, name: int, pdf: pd.DataFrame, buckets: int) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
    """A block and what the owners say of its words, both in the order of the words' numbers, which all blocks
    share. A word's number is its rank among its owner's, dealt out over the owners, so that frequent words have
    small numbers."""
    pdf, block = pdf.sort_values("bucket"), _load(f"{folder}/{UNNUMBERED}", f"block-{name}")
    parts = [_unpack(x, np.uint64) for x in pdf["ranks"]]
    number = np.concatenate([x * np.uint64(buckets) + np.uint64(b) for x, b in zip(parts, pdf["bucket"])])
    order = np.argsort(number)
    told = {
        "counts": np.concatenate([_unpack(x, np.int64) for x in pdf["counts"]])[order],
        "alone": np.packbits(np.concatenate([_unbits(x, len(y)) for x, y in zip(pdf["alone"], parts)])[order]),
        "steps": np.diff(number[order], prepend=np.uint64(0)),
    }
    place = np.argsort(order)
    # The start mark is the first in the order of hashes.
    return {x: block[x] for x in ("length", "held", "doc")} | {"ids": place[block["words"]][block["ids"]], "start": place[:1]}, told


def _grams_told(pdf: pd.DataFrame) -> dict[str, np.ndarray]:
    """The owners' answers to a block: counts and, once for each run of a history within an owner's n-grams, statistics."""
    pdf = pdf.sort_values("bucket")
    counts = [_unpack(x, np.int64) for x in pdf["counts"]]
    return {
        "counts": np.concatenate(counts),
        "alone": np.packbits(np.concatenate([_unbits(x, len(y)) for x, y in zip(pdf["alone"], counts)])),
        "stats": np.concatenate([_unpack(x, np.int64) for x in pdf["stats"]]).reshape(-1, TOLD),
    }


def _probable(told: dict[str, np.ndarray], levels: list[_Level], number: np.ndarray, k: int, states: list[_State], buckets: int, unigrams: Unigrams, models: list) -> _State:
    """Probabilities of a block's n-grams of level ``k``: from the owners' answers, and from the block's own
    counts where nobody else has the history."""
    (d, hot), level, below = models[k - 2], levels[k - 1], states[k - 2]
    d_below = models[k - 3][0] if k > 2 else unigrams.d
    order, bucket = _dealt(levels, number, k, below, buckets)
    h, size = level.history, len(below.counts)
    total, alone = level.train.astype(np.int64), np.ones(len(level.history), dtype=bool)
    own = total > 0
    own[order] = False
    frees, weighs = np.arange(1, LARGEST + 1) * (1 - d[1:]), np.arange(1, LARGEST + 1) * d_below[1:]
    c = below.counts[level.lower[own]]
    freed = np.bincount(h[own], weights=np.append(0, np.append(frees, 0))[np.minimum(total[own], LARGEST + 1)], minlength=size)
    weight = np.bincount(h[own], weights=_factors(d_below, c) * c, minlength=size)
    total[order] = told["counts"]
    alone[order] = np.unpackbits(told["alone"], count=len(order)).astype(bool)
    lead = np.ones(len(order), dtype=bool)
    lead[1:] = (h[order[1:]] != h[order[:-1]]) | (bucket[1:] != bucket[:-1])
    lead, stats = h[order[lead]], told["stats"].reshape(-1, TOLD)
    for i in np.flatnonzero(below.counts[lead] >= HOT):
        stats[i] = hot.get(int(levels[k - 2].hash[lead[i]].view(np.int64)), stats[i])
    freed[lead] = stats[:, :LARGEST] @ frees
    weight[lead] = stats[:, LARGEST:-1] @ weighs + stats[:, -1]
    # What the seen words' counts on the level below are shares of.
    of = np.maximum(below.whole[levels[k - 2].lower], 1) if k > 2 else max(unigrams.tokens, 1) / unigrams.scale
    counts = below.counts
    known = counts > 0
    # A history that frees nothing counts one token more, for all words not seen after it.
    whole = np.where(freed > 0, counts, counts + 1)
    mass = np.where(known, np.where(freed > 0, freed, 1.0) / np.maximum(whole, 1), 1.0)
    alpha = np.where(known, mass / np.maximum(1 - weight / of, 1e-300), 1.0)
    p = np.where(total > 0, _factors(d, total) * total / np.maximum(whole[h], 1), alpha[h] * below.p[level.lower])
    return _State(total, p, alone, whole)


def _known(block, told: list[dict[str, np.ndarray]], buckets: int, unigrams: Unigrams, models: list, upto: int) -> tuple[list[_Level], np.ndarray, list[_State]]:
    """A block's n-grams up to length ``upto``, the words' numbers, and what is known of each level that ``told`` has."""
    number = np.cumsum(told[0]["steps"])
    words = np.zeros(len(number), np.uint64)
    words[block["start"]] = START
    levels = _levels(block | {"words": words}, upto, number)
    counts = told[0]["counts"]
    states = [_State(counts, unigrams(counts), np.unpackbits(told[0]["alone"], count=len(counts)).astype(bool), counts)]
    for k, of_level in enumerate(told[1:], 2):
        states.append(_probable(of_level, levels, number, k, states, buckets, unigrams, models))
    return levels, number, states


def _keep_told(folder: str, k: int, buckets: int):
    """A function that keeps what a block is told of level ``k``; of words also the block with their numbers."""

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        if k == 1:
            block, told = _words_told(folder, key[0], pdf, buckets)
            _save(folder, f"block-{key[0]}", **block)
        else:
            told = _grams_told(pdf)
        _save(folder, f"level-{k}-{key[0]}", **told)
        return pd.DataFrame({"block": [key[0]]})

    return run


def _next_level(folder: str, k: int, buckets: int, unigrams: Unigrams, models: list):
    """A function over blocks that asks for level ``k`` with what they were told of the levels below."""

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        block, told = _load(folder, f"block-{key[0]}"), [_load(folder, f"level-{j}-{key[0]}") for j in range(1, k)]
        levels, number, states = _known(block, told, buckets, unigrams, models, k)
        return _ask_grams(key[0], levels, number, k, states, buckets)

    return run


def _score(folder: str, order: int, buckets: int, unigrams: Unigrams, models: list, columns: list[str]):
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        if order == 1:
            block, last = _words_told(folder, key[0], pdf, buckets)
        else:
            block, last = _load(folder, f"block-{key[0]}"), _grams_told(pdf)
        told = [*[_load(folder, f"level-{k}-{key[0]}") for k in range(1, order)], last]
        levels, _, states = _known(block, told, buckets, unigrams, models, order)
        ids, first, words = levels[0].at, _first(block), states[0].counts
        of_token = np.append(states[-1].p, 1.0)[levels[-1].at]
        # The first words of a text have n-grams of the lower levels only.
        for k in range(order - 1, 0, -1):
            of_token = np.where(levels[k].at >= 0, of_token, states[k - 1].p[levels[k - 1].at])
        base_p = np.log10((words + 0.5) / (unigrams.tokens + 0.5 * (unigrams.types + 1)))
        doc = json.loads(block["doc"].tobytes())
        out = pd.DataFrame({
            "doc_id": pd.Series(doc, dtype=object if any(x is None for x in doc) else None),
            "held_out": block["held"].astype(bool),
            "n_tokens": block["length"].astype(np.int64),
            "n_known": np.add.reduceat((words > 0)[ids].astype(np.int64), first),
            "train_tokens": np.full(len(first), unigrams.tokens, dtype=np.int64),
            "base_score": np.add.reduceat(base_p[ids], first),
            "score": np.add.reduceat(np.log10(of_token), first),
        })
        return out[columns]

    return run


def _kept(df: DataFrame, path: str) -> DataFrame:
    """``df`` written at ``path`` under the shared folder and read back. What was shuffled for it is released:
    from then on only the table is read."""
    spark = df.sparkSession
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(RELEASE)
        else:
            spark.conf.set(RELEASE, before)
    return spark.read.schema(df.schema).parquet(path)


def _delete(path: str) -> None:
    """The folder goes; there is none where no block was written."""
    fs, root = pafs.FileSystem.from_uri(path)
    if fs.get_file_info(root).type != pafs.FileType.NotFound:
        fs.delete_dir(root)


def _totals(answers: DataFrame) -> tuple[int, int, np.ndarray]:
    each = [F.sum(F.element_at("ofs", r + 1)).alias(f"n{r}") for r in range(LARGEST + 2)]
    row = answers.filter("kind = 'total'").agg(F.sum("n").alias("n"), F.sum("v").alias("v"), *each).first()
    return int(row["n"] or 0), int(row["v"] or 0), np.array([row[f"n{r}"] or 0.0 for r in range(LARGEST + 2)])


def katz_scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", order: int = 3) -> DataFrame:
    """One row per document row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (by a
    model of n-grams of up to ``order`` words)."""
    if order < 1:
        raise ValueError("the order is 1 or more")
    docs = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    schema = T.StructType([T.StructField("doc_id", docs.schema["id"].dataType), *T._parse_datatype_string("held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double").fields])
    folder = scratch_dir(docs.sparkSession, "katz")
    buckets = max(16, BUCKETS_PER_TASK * docs.rdd.getNumPartitions())
    columns = [f.name for f in schema.fields]

    asked, merged, unigrams, models = _ask_words(docs, folder, buckets), _count_words, None, []
    for k in range(1, order + 1):
        if k > 1:
            # A block writes down what it is told, and the table goes before the blocks ask again.
            blocks = _kept(answers.filter("kind = 'answer'").groupBy("block").applyInPandas(_keep_told(folder, k - 1, buckets), "block long"), f"{folder}/blocks-{k - 1}")
            _delete(path)
            if k == 2:
                _delete(f"{folder}/{UNNUMBERED}")
            # So few rows would meet in one task.
            blocks = blocks.repartition(max(1, blocks.count()), "block")
            asked, merged = blocks.groupBy("block").applyInPandas(_next_level(folder, k, buckets, unigrams, list(models)), ASK), _merge_grams(k)
        path = scratch_dir(docs.sparkSession, f"counts-{k}")
        answers = _kept(asked.groupBy("bucket").applyInPandas(merged, ANSWER), path)
        tokens, types, n = _totals(answers)
        if k == 1:
            unigrams = Unigrams(tokens, types, n)
            continue
        parts = answers.filter("kind = 'part'").groupBy("history").agg(F.array(*[F.sum(F.element_at("ofs", r + 1)) for r in range(TOLD)]).alias("s"))
        # At most one row for each HOT tokens of the corpus.
        models.append((discounts(n), {r["history"]: list(r["s"]) for r in parts.collect()}))
    return answers.filter("kind = 'answer'").groupBy("block").applyInPandas(_score(folder, order, buckets, unigrams, models, columns), schema)
