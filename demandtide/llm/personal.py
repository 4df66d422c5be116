"""Personal data by a skip-chain conditional random field.

Patterns find e-mail addresses, IP addresses, card and phone numbers (the *base* spans). The field
then judges looser mentions, such as a phone number without its country code or an address written
with "[at]", together with all base spans of the document. Its potentials:

* each mention's features (digits, separators, form) for each label,
* a chain between neighbouring mentions,
* skip edges between mentions that share their digits or name, or most of them, however far apart; numbers
  of four to eight digits must share all.

Loopy belief propagation passes messages along both kinds of edges until they settle, so a number that is
certainly a phone number in one place makes its other mentions one. Base spans are certain and stay.
Mentions that share a key are linked one to the next, never all with all.

The weights are fitted by pseudo-likelihood, with the base spans as labels, to at most ``train_docs`` documents
that hold mentions (those of the smallest hash), the first ``train_mentions`` of each; everything else covers all
documents. Messages that have not settled after ``ROUNDS`` rounds are used as they are.

Defined results: a null or empty text has no spans; repeated rows get equal results each; without any
mention the field is not fitted and only base spans (none) are given; an empty table gives an empty
table; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


KINDS = ("email", "ip", "card", "phone")
LABELS = ("other", *KINDS)
ROUNDS, DAMPING, CERTAIN = 20, 0.5, 0.8
# Prior means of what agreement along a skip edge is worth, in nats: few documents repeat a mention,
# so the data alone say little about them.
SAME, SIMILAR = 5.0, 3.0

LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9][0-9.]*")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ANY = re.compile(r"[0-9@]|[\[({] ?at ?[\])}]")
# Looser forms: digits with up to three separators between two, and addresses spelt out.
LOOSE_DIGITS = re.compile(r"[+(]?[0-9](?:[\x20()./-]{0,3}[0-9])*")
LOOSE_AT = re.compile(r"\x20?(?:@|[\[({]\x20?at\x20?[\])}])\x20?")
LOOSE_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\x20?(?:\.|[\[({]\x20?dot\x20?[\])}])\x20?[A-Za-z0-9-]+)+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        total += v if i % 2 == 0 else v * 2 - 9 * (v > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]+", "", text)


def _addresses(text: str, at: re.Pattern, domain: re.Pattern):
    """Leftmost addresses: around each "@" the longest local part after the last address, then the
    domain. Equal to scanning with the whole pattern, but linear on long runs."""
    end = 0
    for m in at.finditer(text):
        i = m.start()
        if i < end:
            continue
        start = i
        while start > end and LOCAL.match(text[start - 1]):
            start -= 1
        if start < i and (found := domain.match(text, m.end())):
            yield start, found.end()
            end = found.end()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end), sorted."""
    out = []
    if "@" in text:
        out += [(s, 0, e) for s, e in _addresses(text, re.compile("@"), DOMAIN)]
    for run in DOTTED.finditer(text):
        for m in IP.finditer(run[0]) if run[0].count(".") > 2 else ():
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
                out.append((run.start() + m.start(), 1, run.start() + m.end()))
    for m in CARD.finditer(text):
        d = _digits(m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def mentions(text: str, known: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, label or -1): base spans and looser mentions beside them, in text order."""
    out = [(s, e, k + 1) for s, k, e in known]
    taken = sorted((s, e) for s, _, e in known)
    starts = np.array([s for s, _ in taken])
    ends = np.maximum.accumulate(np.array([e for _, e in taken])) if taken else np.zeros(0)

    def free(s: int, e: int) -> bool:
        k = int(np.searchsorted(starts, e)) if len(starts) else 0
        return k == 0 or ends[k - 1] <= s

    for m in LOOSE_DIGITS.finditer(text):
        if len(_digits(m[0])) >= 4 and free(*m.span()):
            out.append((*m.span(), -1))
    for s, e in _addresses(text, LOOSE_AT, LOOSE_DOMAIN):
        if free(s, e):
            out.append((s, e, -1))
    return sorted(out)


def features(text: str, start: int, end: int) -> np.ndarray:
    """0/1 features of a mention and the characters beside it."""
    x = text[start:end]
    d = _digits(x)
    n = len(d)
    at = "@" in x or bool(LOOSE_AT.search(x))
    inner = x[1:-1]
    glued = (start > 0 and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum())
    return np.array([1, at, at and "." in x, n == 0, 1 <= n <= 6, 7 <= n <= 8, 9 <= n <= 11, 12 <= n <= 15, 16 <= n <= 19, n > 19, x[:1] == "+", "(" in x, x.count(".") == 3, "-" in inner, " " in inner, "." in inner, bool(re.search("[A-Za-z]", x)), 12 <= n <= 19 and luhn(d), glued, x[:1] in "=\"'"], dtype=float)


N_FEATURES = 20


def skip_keys(text: str, start: int, end: int) -> tuple[str, str]:
    """What repeated mentions share, and what similar ones share; "" for nothing."""
    x = text[start:end]
    if "@" in x or LOOSE_AT.search(x):
        name = re.sub(r"[^a-z0-9]+", "", LOOSE_AT.sub("", x.lower()).replace("dot", ""))
        return "a" + name, "a" + name[:10]
    d = _digits(x)
    if len(d) >= 9:
        # The last ten digits: a country code may be left out.
        return "d" + d[-10:], "d" + d[-10:-2]
    # Short numbers repeat as a whole; of numbers of fewer than four digits a repetition says nothing.
    return ("s" + d, "") if len(d) >= 4 else ("", "")


def edges(text: str, found: list[tuple[int, int, int]], reach: int = 60) -> list[tuple[int, int, int]]:
    """(mention, mention, kind): 0 chain, 1 same key, 2 similar key."""
    out = [(i, i + 1, 0) for i in range(len(found) - 1) if found[i + 1][0] - found[i][1] <= reach]
    last: tuple[dict[str, int], dict[str, int]] = ({}, {})
    for i, (s, e, _) in enumerate(found):
        same, similar = skip_keys(text, s, e)
        for kind, key in ((1, same), (2, similar)):
            if key:
                before = last[kind - 1].get(key)
                if before is not None and not (kind == 2 and last[0].get(same) is not None):
                    out.append((before, i, kind))
        for kind, key in ((1, same), (2, similar)):
            if key:
                last[kind - 1][key] = i
    return out


def potentials(w: np.ndarray) -> np.ndarray:
    """Pair potentials of the three kinds of edges: chain, same key, similar key."""
    k = len(LABELS)
    out = np.zeros((3, k, k))
    out[0] = w[: k * k].reshape(k, k)
    for kind in (1, 2):
        np.fill_diagonal(out[kind], w[k * k + (kind - 1) * k : k * k + kind * k])
    return out


N_PAIR = len(LABELS) * (len(LABELS) + 2)


def fit(documents: list[tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]], steps: int = 150, rate: float = 0.3, decay: float = 0.02) -> tuple[np.ndarray, np.ndarray]:
    """Weights that maximise the pseudo-likelihood: each mention's label given its features and its
    neighbours' labels. ``documents``: features, labels, edges."""
    k = len(LABELS)
    at = np.cumsum([0] + [len(y) for _, y, _ in documents])
    x, y = np.concatenate([d[0] for d in documents]), np.concatenate([d[1] for d in documents])
    links = np.array([(a + o, b + o, kind) for o, (_, _, es) in zip(at, documents) for a, b, kind in es], dtype=int).reshape(-1, 3)
    prior = np.concatenate([np.zeros(k * k), np.full(k, SAME), np.full(k, SIMILAR)])
    unary, pair = np.zeros((N_FEATURES, k)), prior.copy()
    one = np.eye(k)[y]
    # Adagrad on the mean; skip edges only ever reward agreement.
    seen_u, seen_p = np.full_like(unary, 1e-8), np.full_like(pair, 1e-8)
    for _ in range(steps):
        v = potentials(pair)
        score = x @ unary
        a, b, kind = links.T
        np.add.at(score, a, v[kind, :, y[b]])
        np.add.at(score, b, v[kind, y[a], :])
        p = np.exp(score - score.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        miss = one - p
        g_u = x.T @ miss / len(y) - decay * unary / len(y) ** 0.5
        g = np.zeros((3, k, k))
        np.add.at(g, (kind, slice(None), y[b]), miss[a])
        np.add.at(g, (kind, y[a], slice(None)), miss[b])
        g_p = np.concatenate([g[0].reshape(-1), np.diag(g[1]), np.diag(g[2])]) / len(y) - decay * (pair - prior) / len(y) ** 0.5
        seen_u += g_u**2
        seen_p += g_p**2
        unary += rate * g_u / np.sqrt(seen_u)
        pair += rate * g_p / np.sqrt(seen_p)
        pair[k * k :] = np.maximum(pair[k * k :], 0)
    return unary, pair


def beliefs(score: np.ndarray, links: list[tuple[int, int, int]], pair: np.ndarray) -> np.ndarray:
    """Marginals by loopy sum-product; ``score`` holds the mentions' own potentials."""
    def normal(z):
        return z - np.logaddexp.reduce(z, axis=-1, keepdims=True)

    if not links:
        return np.exp(normal(score))
    a, b, kind = np.array(links).T
    v = potentials(pair)[kind]
    source, target = np.concatenate((a, b)), np.concatenate((b, a))
    table = np.concatenate((v, v.transpose(0, 2, 1)))
    back = np.concatenate((np.arange(len(a)) + len(a), np.arange(len(a))))
    message = np.zeros((len(source), score.shape[1]))
    for _ in range(ROUNDS):
        total = score.copy()
        np.add.at(total, target, message)
        new = normal(np.logaddexp.reduce((total[source] - message[back])[:, :, None] + table, axis=1))
        if np.abs(new - message).max() < 1e-4:
            break
        message = DAMPING * message + (1 - DAMPING) * new
    total = score.copy()
    np.add.at(total, target, message)
    return np.exp(normal(total))


def field_spans(text: str, known: list[tuple[int, int, int]], unary: np.ndarray, pair: np.ndarray) -> list[tuple[int, int, int]]:
    """Spans the field adds to the base spans."""
    found = mentions(text, known)
    if not any(k < 0 for _, _, k in found):
        return []
    score = np.array([features(text, s, e) for s, e, _ in found]) @ unary
    sure = np.array([k for _, _, k in found])
    score[sure > 0] = -30.0
    score[sure > 0, sure[sure > 0]] = 0.0
    p = beliefs(score, edges(text, found), pair)
    best = p.argmax(1)
    return [(s, int(best[i]) - 1, e) for i, (s, e, k) in enumerate(found) if k < 0 and best[i] and p[i, best[i]] >= CERTAIN]


def _training(docs: DataFrame, train_docs: int, train_mentions: int) -> list:
    """The first ``train_mentions`` mentions of each training document, as bare features, labels and edges."""
    schema = T.StructType([T.StructField("x", T.ArrayType(T.ArrayType(T.DoubleType()))), T.StructField("y", T.ArrayType(T.IntegerType())), T.StructField("e", T.ArrayType(T.ArrayType(T.IntegerType())))])
    marked = docs.filter(F.col("text").rlike(ANY.pattern)).select(F.xxhash64("id", "text").alias("h"), "text")
    # Hashes alone are put in order; of the texts only the chosen ones move.
    last = marked.select("h").orderBy("h").limit(train_docs).agg(F.max("h")).first()[0]
    held = marked.filter(F.col("h") <= F.lit(last)).select("text").limit(train_docs)

    def run(batches):
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                found = mentions(text, base_spans(text))[:train_mentions]
                if found:
                    rows.append({"x": [features(text, s, e).tolist() for s, e, _ in found], "y": [max(0, k) for _, _, k in found], "e": [list(t) for t in edges(text, found)]})
            yield pa.RecordBatch.from_pylist(rows, schema=to_arrow_schema(schema))

    rows = held.mapInArrow(run, schema).collect()
    return [(np.array(r["x"]), np.array(r["y"]), [tuple(t) for t in r["e"]]) for r in rows]


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", train_docs: int = 2000, train_mentions: int = 100) -> DataFrame:
    """One row per document row: doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256,
    spans (all), n_added. The weights come from at most ``train_docs`` documents and ``train_mentions``
    mentions of each, so what reaches the driver is bounded whatever the documents' length."""
    docs = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    weights = fit(rows) if (rows := _training(docs, train_docs, train_mentions)) else None
    schema = T.StructType([T.StructField("doc_id", docs.schema["id"].dataType), *[T.StructField(f"n_{k}", T.LongType()) for k in KINDS], T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()), T.StructField("n_added", T.LongType())])

    def run(batches):
        arrow = to_arrow_schema(schema)
        for batch in batches:
            out = []
            for value in batch.column("text"):
                t = value.as_py() or ""
                known, added = [], []
                if ANY.search(t):
                    known = base_spans(t)
                    added = field_spans(t, known, *weights) if weights else []
                one = _joined(known)
                counts = [sum(k == i for _, k, _ in known) for i in range(len(KINDS))]
                out.append((*counts, hashlib.sha256(one.encode()).hexdigest(), _joined(sorted(known + added)), len(added)))
            columns = zip(*out) if out else [[] for _ in list(arrow)[1:]]
            yield pa.RecordBatch.from_arrays([batch.column("id").cast(arrow.field("doc_id").type), *[pa.array(c, f.type) for c, f in zip(columns, list(arrow)[1:])]], schema=arrow)

    return docs.mapInArrow(run, schema)
