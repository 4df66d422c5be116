"""The filters' audit against playing every order through."""

import itertools

from demandtide.llm import audit

LONG = " ".join(f"w{i}" for i in range(120))


def _played(rows, labels):
    """Documents removed filter by filter, in plain Python."""
    quality = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, x, _ in rows:
        if i is not None:
            least[x or ""] = min(i, least.get(x or "", i))
    docs = []
    for i, x, part in rows:
        x = x or ""
        words = x.split()
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in x) > 10 * len(x), "D": any(c in "#$%&*|" for c in x), "E": i is not None and i > least[x]}
        docs.append((part or "", {k for k, v in fails.items() if v}, i in quality, i in toxic))
    out, total = {}, {}
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [d for d in left if letter in d[1]]
                left = [d for d in left if letter not in d[1]]
                failing = sum(letter in d[1] for d in mine)
                out[part, order, step] = [len(left), len(gone), failing - len(gone), sum(d[1] == {letter} for d in mine), sum(d[2] for d in gone), sum(d[3] for d in gone)]
                total[part, letter] = total.get((part, letter), 0) + len(gone)
    return {k: (*v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def _got(spark, rows, labels):
    docs = spark.createDataFrame([(*r, 1, True) for r in rows], "doc_id bigint, text string, lang string, good int, toxic boolean")
    found = audit.audit(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).collect()
    got = {(r[0], r[1], r[2]): tuple(r[3:]) for r in found}
    assert len(got) == len(found)
    return got


def test_every_order_against_playing_it(spark):
    texts = [LONG, LONG + " #", LONG.upper(), "few words", "", None, ("a b " * 80), LONG + " " + "A" * 300 + " | a", "x" * 200_000]
    rows = [(i, texts[i % len(texts)], ["en", "de", None, ""][i % 4]) for i in range(60)]
    # Repeated rows, rows without an id, and copies in another part with the smallest id.
    rows += [rows[0], rows[0], (None, LONG, "en"), (None, LONG, "en"), (None, None, "de"), (-5, LONG, "fr")]
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 60, 2)] + [(4, 1, None), (4, None, 1), (None, 1, 1), (999, 1, 1)]
    assert _got(spark, rows, labels) == _played(rows, labels)


def test_no_documents_and_no_labels(spark):
    assert _got(spark, [], [(1, 1, 1)]) == {}
    rows = [(1, "a", None)]
    assert _got(spark, rows, []) == _played(rows, [])


def test_one_text_for_most_rows(spark):
    rows = [(i, LONG if i % 3 else f"{LONG} {i}", "en") for i in range(900)]
    got = _got(spark, rows, [(i, 1, 0) for i in range(900)])
    assert got["en", "EABCD", 1] == (301, 599, 0, 599, 599, 0, 120 * 599)
