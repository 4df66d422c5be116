"""The line rules in code and in SQL on planted lines, and repeated windows in every case."""

import itertools
import random

import duckdb
import pandas as pd
import pytest

from demandtide.llm import quality, sql

LINES = [
    "plain words that say something about a thing",
    " ".join(f"word{i}" for i in range(121)) + " | a | b | c",
    "home | about | contact | help",
    "one › two › three",
    " ".join(f"mot{i}" for i in range(40)) + " « un » et « deux » et « trois »",
    "Menu:",
    "a word |",
    "SHOUTING ALL THE TIME HERE",
    "SHOUTING ALL THE Time HERE",
    "هذا نص عربي بسيط عن شيء ما",
    "यह एक साधारण वाक्य है",
    "12 34 56 78",
    "12 34",
    "Click here to read more",
    "Click here to " + " ".join(f"read{i}" for i in range(30)),
    "Sign in to",
    "this site uses cookies and more",
    "really!! yes?? no!!",
    "a!! " + " ".join(f"w{i}" for i in range(10)),
    "price $5 & more # here",
    "\tindented words of a line \r",
    "• point",
    "• a point with many more words in it",
]


def _rows(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_failed_lines", "lost_chars")
    return sorted((r["doc_id"], *[r["q"][f] for f in fields]) for r in quality.judged(docs).collect())


def test_sql_states_the_rules_of_the_code(spark):
    rng = random.Random(1)
    filler = "\n".join(" ".join(f"t{rng.randrange(500)}" for _ in range(12)) for _ in range(6))
    texts = [*LINES, *[f"{line}\n{filler}" for line in LINES], *["\n".join(rng.choices(LINES, k=rng.randrange(1, 30))) for _ in range(80)], "", None, " \n\t"]
    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"doc_id": range(len(texts)), "text": texts}))
    columns = "doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_failed_lines, lost_chars"
    want = sorted(con.execute(f"SELECT {columns} FROM ({sql.quality('documents')})").fetchall())
    assert _rows(spark, texts) == want


@pytest.mark.parametrize("place_bits", [24, 60])
def test_windows_that_share_a_hash(spark, monkeypatch, place_bits):
    """With four bits of hash nearly all windows collide; the counts stay exact."""
    monkeypatch.setattr(quality, "PLACE_BITS", place_bits)
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abcdef") for _ in range(n)) for n in (3, 10, 40, 200)]
    for row, text in zip(_rows(spark, texts), texts):
        w = text.split()
        windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        hit = {p for i, j in itertools.permutations(range(len(windows)), 2) if windows[i] == windows[j] for p in range(i, i + 3)}
        assert row[5] == len(hit)
