"""The operators' queries against their SQL, and what SQL cannot say against brute force."""

import collections
import functools
import hashlib
import html
import math
import re
import zlib

import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from demandtide.llm import base, katz, personal, sql
from demandtide.llm.queries import QUERIES
from tests.compare import connect, difference
from tests.conftest import SF


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


@pytest.mark.parametrize("name", sorted(sql.ORACLES))
def test_query_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, sql.ORACLES[name]) is None


def test_pipeline_equals_sql(spark, con):
    assert difference(corpus_pipeline.run(spark, SF), con, corpus_pipeline.ORACLE_SQL) is None


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns


def _plain_spans(text):
    digits = lambda x: re.sub(r"\D", "", x)
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 12 <= len(digits(m[0])) <= 19 and personal.luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(out)


def test_personal_data_against_plain_patterns(spark, texts):
    rows = QUERIES["op2_personal_data"](spark, SF).collect()
    assert {r["doc_id"] for r in rows} == set(texts) and len(rows) == len(texts)
    for r in rows:
        spans = _plain_spans(texts[r["doc_id"]])
        joined = ",".join(f"{personal.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in personal.KINDS] == [sum(x == i for _, x, _ in spans) for i in range(4)]
        assert set(filter(None, joined.split(","))) <= set(r["spans"].split(","))


def _katz(texts, order):
    """The model in plain Python: a function from a word and its history to its probability."""
    tokens = {i: [*x.encode().lower().split(), None] for i, x in texts.items()}
    train = {i: w for i, w in tokens.items() if zlib.crc32(str(i).encode()) % 5 != 1}
    count = [collections.Counter() for _ in range(order + 1)]
    for w in train.values():
        marked = ["<s>", *w]
        for t in range(1, len(marked)):
            for k in range(1, min(order, t + 1) + 1):
                count[k][tuple(marked[t - k + 1 : t + 1])] += 1
    count[0]["<s>"] = len(train)

    def factor(counts):
        n = collections.Counter(counts.values())
        cut = 6 * n[6] / n[1] if n[1] else 1
        d = {r: ((r + 1) * n[r + 1] / (r * n[r]) - cut) / (1 - cut) if n[r] and cut < 1 else 1.0 for r in range(1, 6)}
        return lambda c: d[c] if c <= 5 and 0 < d[c] < 1 else 1.0

    d = [None, *[factor(count[k]) for k in range(1, order + 1)]]
    total = sum(count[1].values())
    unseen = sum(c * (1 - d[1](c)) for c in count[1].values()) / total
    after = [collections.defaultdict(dict) for _ in range(order + 1)]
    for k in range(2, order + 1):
        for g, c in count[k].items():
            after[k][g[:-1]][g[-1]] = c

    @functools.cache
    def weight(h):
        """Tokens of the history, as they count, and its back-off weight."""
        k = len(h) + 1
        seen = after[k].get(h)
        if not seen:
            return 1, 1.0
        freed = sum(c * (1 - d[k](c)) for c in seen.values())
        whole = sum(seen.values()) + (freed <= 0)
        return whole, (freed if freed > 0 else 1) / whole / (1 - sum(prob(w, h[1:]) for w in seen))

    def prob(w, h):
        if not h:
            c = count[1][w,]
            return d[1](c) * c / total if c else unseen
        c = count[len(h) + 1][(*h, w)]
        whole, alpha = weight(h)
        return d[len(h) + 1](c) * c / whole if c else alpha * prob(w, h[1:])

    return tokens, train, {g[0]: c for g, c in count[1].items()}, prob, after


@pytest.mark.parametrize("order, small", [(3, False), (3, True), (1, True), (2, True), (4, True)])
def test_katz_against_plain_counts(spark, texts, monkeypatch, order, small):
    """Every order; also with many blocks and histories of several owners."""
    if small:
        monkeypatch.setattr(katz, "BLOCK_TOKENS", 5000)
        monkeypatch.setattr(katz, "HOT", 500)
    tokens, train, one, prob, after = _katz(texts, order)
    total = sum(one.values())
    found = katz.katz_scores(spark.read.parquet(f"{SF}/documents.parquet"), order=order) if small else QUERIES["op5_katz"](spark, SF)
    rows = {r["doc_id"]: r for r in found.collect()}
    assert set(rows) == set(texts)
    for i, w in tokens.items():
        r = rows[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (i not in train, len(w), sum(x in one for x in w), total)
        assert math.isclose(r["base_score"], sum(math.log10((one.get(x, 0) + 0.5) / (total + 0.5 * (len(one) + 1))) for x in w), abs_tol=1e-6)
        marked = ["<s>", *w]
        assert math.isclose(r["score"], sum(math.log10(prob(marked[t], tuple(marked[max(0, t - order + 1) : t]))) for t in range(1, len(marked))), rel_tol=1e-9, abs_tol=1e-6)
    for k in range(2, order + 1):
        for h in list(after[k])[:20]:
            left = 1 - sum(prob(w, h[1:]) for w in after[k][h])
            assert math.isclose(sum(prob(w, h) for w in after[k][h]) + prob(b"no such word", h) / prob(b"no such word", h[1:]) * left, 1, rel_tol=1e-9)
    held = [r for r in rows.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_katz_counts_beyond_32_bits():
    """An owner's sums and discounts of counts that do not fit in 32 bits."""
    word = np.array([7 << 16, 9 << 16], np.uint64)
    short = word >> np.uint64(16)
    packed = short.astype(np.uint32).tobytes() + (short >> np.uint64(32)).astype(np.uint16).tobytes()
    big = np.array([3 << 40, 1], np.int64)
    ask = lambda block: {"block": block, "bucket": 0, "words": packed, "counts": katz._pack(big), "lower": katz._pack(np.array([0.25, 0.125])), "runs": katz._pack(np.array([2], np.uint32)), "histories": np.array([5, 0], np.uint64).tobytes()}
    out = katz._count_grams(pd.DataFrame([ask(1), ask(2)]))
    answers = out[out["kind"] == "answer"]
    for packed_counts, packed_stats in zip(answers["counts"], answers["stats"]):
        assert katz._unpack(packed_counts, np.int64).tolist() == [6 << 40, 2]
        assert katz._unpack(packed_stats, np.float64)[:5].tolist() == [0, 1, 0, 0, 0]
    words = pd.DataFrame([{"block": b, "words": word.tobytes(), "counts": katz._pack(big)} for b in (1, 2)]).assign(bucket=0)
    out = katz._count_words(words)
    assert int(out.loc[out["kind"] == "total", "n"].iloc[0]) == (6 << 40) + 2
    assert [katz._unpack(x, np.int64).tolist() for x in out.loc[out["kind"] == "answer", "counts"]] == [[6 << 40, 2]] * 2
    assert katz.Unigrams((6 << 40) + 2, 2, np.array([0, 0, 1, 0, 0, 0, 0]))(np.array([6 << 40]))[0] == pytest.approx(1, rel=1e-9)


def test_katz_leaves_little_behind(spark, monkeypatch, tmp_path):
    """Of the levels' answers only the last stay, and the session's setting is as it was."""
    folder = lambda spark, label: f"{tmp_path}/{label}"
    monkeypatch.setattr(katz, "scratch_dir", folder)
    monkeypatch.setattr(base, "scratch_dir", folder)
    katz.katz_scores(spark.read.parquet(f"{SF}/documents.parquet"))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["counts-3", "katz"]
    assert spark.conf.get(katz.RELEASE, "false") == "false"


def test_katz_keeps_answers_once(spark, monkeypatch, tmp_path):
    """When blocks ask for a level, the tables of answers below it and the words' hashes have gone."""
    folder, there, kept = lambda spark, label: f"{tmp_path}/{label}", [], katz._kept

    def watched(df, *rest):
        there.append(sorted(str(p.relative_to(tmp_path)) for p in [*tmp_path.glob("counts-*"), *tmp_path.glob("katz/unnumbered")]))
        return kept(df, *rest)

    monkeypatch.setattr(katz, "scratch_dir", folder)
    monkeypatch.setattr(katz, "_kept", watched)
    katz.katz_scores(spark.read.parquet(f"{SF}/documents.parquet"))
    assert there == [[], ["counts-1", "katz/unnumbered"], [], ["counts-2"], []]
    for path in tmp_path.glob("katz/block-*"):
        assert set(np.load(path)) == {"ids", "length", "held", "doc", "start"}


def test_katz_owners_tell_whole_numbers():
    """Of a history: words seen 1 to 5 times, seen words with such counts below, the other seen words' counts there."""
    word, train, lower = np.arange(1, 7, dtype=np.uint64), np.array([1, 1, 2, 0, 9, 0]), np.array([1, 4, 4, 0, 70, 0])
    packed = word.astype(np.uint32).tobytes() + np.zeros(6, np.uint16).tobytes()
    row = {"bucket": 0, "words": packed, "runs": katz._pack(np.array([4, 2])), "histories": np.array([5, 8, 0, 0], np.uint64).tobytes()}
    ask = pd.DataFrame([row | {"block": 1, "counts": katz._pack(train), "lower": katz._pack(lower)}, row | {"block": 2, "counts": katz._pack(train * 0), "lower": katz._pack(lower * 0)}])
    out = katz._count_grams(ask)
    for packed_stats in out.loc[out["kind"] == "answer", "stats"]:
        stats = katz._unpack(packed_stats)
        assert stats.dtype.kind == "i"
        assert stats.reshape(2, -1).tolist() == [[2, 1, 0, 0, 0, 1, 0, 0, 2, 0, 0], [0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 70]]


def test_katz_asks_only_where_others_may_know(monkeypatch):
    """What follows a history of this block alone, or of no training text, stays in the block."""
    words = np.array([5, 6, 7, int(katz.START)], np.uint64)
    block = {"words": words, "ids": np.array([0, 1, 2, 0, 2]), "length": np.array([5]), "held": np.array([0])}
    levels = katz._levels(block, 2, number := np.arange(4, dtype=np.uint64))
    known = lambda alone, counts: [katz._State(np.array(counts), np.full(4, 0.25), np.array(alone), np.array(counts))]
    after = lambda ask: sum(katz._unpack(x, np.int64).sum() for x in ask["runs"] if x)
    assert after(katz._ask_grams(1, levels, number, 2, known([False] * 4, [2, 1, 2, 1]), 4)) == 5
    ask = katz._ask_grams(1, levels, number, 2, known([False, True, True, False], [2, 1, 2, 0]), 4)
    assert after(ask) == 2 and ask["n"].sum() == 3


def test_katz_packing():
    rng = np.random.default_rng(0)
    for x in (np.zeros(0, np.int64), np.array([3, 70000, 1 << 40]), np.array([-1, 5]), np.array([0.5, np.nan, 2.0]), np.array([1.0, 255.0]), np.array([2**64 - 1], np.uint64)):
        assert np.array_equal(katz._unpack(katz._pack(x)), x, equal_nan=x.dtype.kind == "f") and katz._unpack(katz._pack(x)).dtype == x.dtype
    table = np.array([[1, 0.5], [2, 0.25], [3, 0.125]])
    assert katz._unpack(katz._pack(table)).reshape(3, 2).tolist() == table.tolist()
    paths = np.unique(rng.integers(0, 9, (200, 3)).astype(np.uint64), axis=0)
    assert np.array_equal(katz._read_paths(katz._sent_paths(paths)), paths)
    for high in (50, 1 << 62):
        x = rng.integers(0, high, 1000)
        assert all(np.array_equal(a, b) for a, b in zip(katz._distinct(x), np.unique(x, return_inverse=True)))


def test_main_text_against_the_marked_articles(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = QUERIES["op6_site_templates"](spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        plain = re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1|br)>", " ", re.sub(r"<!--.*?-->", "", article, flags=re.S)))
        assert r["text"] == " ".join(html.unescape(plain).split())
        assert r["n_chars"] == len(r["text"])
