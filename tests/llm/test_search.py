"""Ranked search against scoring every document."""

import collections
import math
import random
import re

import pytest

from demandtide.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(low)


def _scored(docs, items, k):
    bags = [(i, collections.Counter(_terms(x))) for i, x in docs]
    bags = [(i, b, b.total()) for i, b in bags if b]
    total = sum(n for _, _, n in bags)
    df = collections.Counter(t for _, b, _ in bags for t in b)
    weight = {t: math.floor(1000 * math.log((2 * len(bags) + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item, x in items:
        scores = []
        for i, b, n in bags:
            m = 75 + 25 * n * len(bags) // total
            s = sum(weight[t] * (10**9 * b[t] // (1000 * b[t] + 12 * m)) for t in _terms(x) if t in b)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def _got(spark, docs, items, k=20, parts=3):
    docs = spark.createDataFrame([(*d, 1) for d in docs], "doc_id bigint, text string, score int").repartition(parts)
    items = spark.createDataFrame([(*i, "x") for i in items], "item_id string, text string, doc_id string")
    return sorted((tuple(r) for r in search.ranked(docs, items, k).collect()), key=repr)


def _corpus(seed, n=1200):
    """A few very common terms, many rare ones, copies (equal scores) and odd texts."""
    rnd = random.Random(seed)
    word = lambda: f"w{int(rnd.paretovariate(0.6)) % 3000}"
    texts = [" ".join(word() for _ in range(rnd.randrange(1, 60))) for _ in range(n)]
    texts += texts[:200] + ["", None, "-- !", "Über ÜBER über w1", "w1 " * 5000]
    docs = list(enumerate(texts))
    rnd.shuffle(docs)
    items = [(f"i{q}", " ".join(word() for _ in range(rnd.randrange(1, 40)))) for q in range(40)]
    return docs, items


@pytest.mark.parametrize("block, share, items_at_once", [(4096, 8, 8 << 20), (50, 3, 500), (700, 10**6, 8 << 20), (64, 1, 8 << 20)])
def test_ranks_equal_scoring_all(spark, monkeypatch, block, share, items_at_once):
    """Also with many blocks, with short lists only, with long lists only, and with many batches of items."""
    monkeypatch.setattr(search, "BLOCK_DOCS", block)
    monkeypatch.setattr(search, "SHARE", share)
    monkeypatch.setattr(search, "ITEM_BYTES", items_at_once)
    docs, items = _corpus(block)
    assert _got(spark, docs, items) == _scored(docs, items, 20)


def test_odd_rows(spark):
    docs = [(1, "a b"), (1, "a b"), (None, "a b"), (2, "c"), (3, None), (4, "A, É b"), (5, "é")]
    items = [("x", "a é"), ("x", "a é"), ("x", "b"), ("y", ""), (None, "c"), ("z", None), ("none", "q")]
    assert _got(spark, docs, items) == _scored(docs, items, 20)
    assert _got(spark, docs, items, k=1) == _scored(docs, items, 1)


def test_no_rows(spark):
    assert _got(spark, [], [("x", "a")]) == []
    assert _got(spark, [(1, "a")], []) == []
    assert _got(spark, [(1, ""), (2, None)], [("x", "a")]) == []


def test_most_windows_are_skipped(spark):
    """Documents that hold only a common term are not scored once k better ones are known."""
    import numpy as np
    import pyarrow as pa

    n = 4096
    lengths = np.full(n, 10, np.int64)
    row = {"lengths": lengths, "terms": np.array([5, 9], np.uint64), "sizes": np.array([n, 30], np.uint32), "docs": np.concatenate([np.arange(n), np.arange(30)]).astype(np.uint16), "counts": np.ones(n + 30, np.uint32)}
    block = search._Block({c: pa.scalar(x.tobytes(), pa.binary()) for c, x in row.items()}, np.array([5, 9], np.uint64), np.array([1, 9000]), n, 10 * n)
    seen = []
    block.whole = type("Seen", (), {"__getitem__": lambda _, at: (seen.append(at[1].size), whole[at])[1]})()
    whole = np.ones((1, n), np.int64) * int(block.most[0, 0])
    docs, _ = block.search(np.array([0, 1]), np.array([1, 1]), 20, 1)
    assert docs.tolist() == list(range(20)) and sum(seen) <= 2 * search.WINDOW
