"""Defined results in odd cases: nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import gzip
import io
import itertools
import json
import random
import re
import struct
import zipfile

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from demandtide.llm import archives, decontamination, hashing, jaccard, katz, mixing, personal, quality, sharding, templates, toolcalls
from demandtide.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


# --- 1 ---------------------------------------------------------------------------


def test_decontamination_in_odd_cases(spark):
    words = " ".join(f"w{i}" for i in range(14))
    items = frame(spark, [(1, words), (2, words), (3, "Short Item"), (4, None), (5, "!!"), (6, "one two three four five six"), (None, "alone")], "item_id long, text string")
    docs = frame(spark, [(1, f"x {words.upper()} y"), (2, " ".join(words.split()[:9])), (3, "a short, ITEM. short item"), (4, None), (5, ""), (6, "shortitem"), (6, "one two three four five six " * 2), (6, "one two three four five six " * 2), (7, "lone alone")])
    rows = decontamination.contamination(docs, items).collect()
    got = sorted((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for r in rows)
    assert got == [(1, 16, 14, 2, True), (2, 9, 0, 0, False), (3, 5, 4, 1, True), (4, 0, 0, 0, False), (5, 0, 0, 0, False), (6, 1, 0, 0, False), (6, 12, 12, 1, True), (6, 12, 12, 1, True), (7, 2, 1, 0, True)]
    left = decontamination.without_contaminated(docs.withColumn("bad_id", F.lit(1)), items)
    assert left.columns == ["doc_id", "text", "bad_id"]
    assert sorted(r["doc_id"] for r in left.collect()) == [2, 4, 5, 6]


def test_decontamination_of_empty_tables(spark):
    docs, items = frame(spark, [(1, "a b c")]), frame(spark, [], "item_id long, text string")
    assert [r["contaminated"] for r in decontamination.contamination(docs, items).collect()] == [False]
    assert decontamination.contamination(docs.limit(0), items).count() == 0


def test_decontamination_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", 0)
    items = frame(spark, [(1, "a b c d e f g h i j k l")], "item_id long, text string")
    docs = frame(spark, [(i, "z a b c d e f g h i j" + " k" * (i % 2)) for i in range(50)])
    assert {r["n_hit"] for r in decontamination.contamination(docs, items).collect()} == {10, 11}


# --- 2 ---------------------------------------------------------------------------


def test_field_follows_repeated_mentions():
    rng = random.Random(3)
    train = []
    for _ in range(300):
        n = "".join(rng.choices("0123456789", k=7))
        text = f"call +1 (555) {n[:3]}-{n[3:]} or mail x{n}@mail.example.com in {n[:4]}, item {n[:6]}"
        found = personal.mentions(text, personal.base_spans(text))
        train.append((np.array([personal.features(text, s, e) for s, e, _ in found]), np.array([max(0, k) for *_, k in found]), personal.edges(text, found)))
    weights = personal.fit(train)
    far = " word" * 50
    text = f"call +1 (988) 555-2485 now.{far} again 988-555-2485.{far} 12345 and 2019; other 777-111-2222"
    known = personal.base_spans(text)
    added = personal.field_spans(text, known, *weights)
    assert [(text[s:e], personal.KINDS[k]) for s, k, e in added] == [("988-555-2485", "phone")]
    assert personal.field_spans("in 2019 there were 12345 of 99999 items", [], *weights) == []


def test_personal_data_in_odd_cases(spark):
    long = "a" * 200_000 + "@" + "1" * 100_000 + " 1.2.3.999999"
    rows = by_id(personal.personal_data(frame(spark, [(1, None), (2, ""), (3, "é a@b.co a@b.co"), (4, long), (5, "1.2.3.4.5.6.7.8")])))
    assert rows[1]["spans"] == rows[2]["spans"] == rows[4]["spans"] == ""
    assert rows[3]["spans"] == "email:2:8,email:9:15"
    assert rows[5]["spans"] == "ip:0:7,ip:8:15" and rows[5]["n_ip"] == 2
    assert personal.personal_data(frame(spark, [])).count() == 0


# --- 3 ---------------------------------------------------------------------------


def test_shards_fit_and_only_large_buckets_split(spark):
    rng = random.Random(1)
    rows = [(i, "x" * rng.randint(0, 300)) for i in range(2000)] + [(5000, "y" * 5000), (5001, None)] + [(6000, "same" * 100)] * 30
    out = sharding.shard(frame(spark, [(*r, 1, "s") for r in rows], "doc_id long, text string, hash60 int, shard string"), limit=4000)
    assert out.columns == ["doc_id", "text", "hash60", "shard", "_shard", "shard_bytes", "oversized"]
    got = out.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("b"), F.col("_shard").alias("s"), "shard_bytes", "oversized").toPandas()
    assert len(got) == len(rows)
    sums = got.groupby("s").agg(b=("b", "sum"), said=("shard_bytes", "first"), over=("oversized", "first"), ids=("doc_id", "nunique"))
    assert (sums["b"] == sums["said"]).all()
    assert (sums["over"] == (sums["b"] > 4000)).all() and (sums[sums["over"]]["ids"] == 1).all() and sums["over"].sum() == 2
    names = sorted(sums.index)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))  # no bucket lies in another
    for s in names:  # a bucket's parent was too large
        assert s == "" or got[got["s"].str.startswith(s[:-1])]["b"].sum() > 4000


def test_sharding_of_little(spark):
    assert sharding.shard(frame(spark, [])).count() == 0
    assert {r["shard"] for r in sharding.shard(frame(spark, [(1, "a"), (2, None), (None, "b")])).collect()} == {""}


# --- 4 ---------------------------------------------------------------------------


def repeated(words, n=3):
    windows = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
    return len({p for i, w in enumerate(windows) if windows.count(w) > 1 for p in range(i, i + n)})


def test_quality_figures_and_rules(spark):
    rng = random.Random(2)
    prose = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(200)]
    clean = "\n".join(" ".join(prose[i : i + 20]) + "." for i in range(0, 200, 20))
    loud = clean.upper().replace(" ", "!! ")
    menu = "\n".join(" | ".join(prose[i : i + 20]) for i in range(0, 200, 20))
    texts = {1: clean, 2: loud, 3: menu, 4: None, 5: "", 6: "\n \n", 7: "a b c " * 100, 8: clean + "\nAll rights reserved.\n" + clean.split("\n")[0], 9: " ".join(rng.choices("ab", k=60))}
    df = frame(spark, [(i, t, 0) for i, t in texts.items()], "doc_id long, text string, q int")
    rows = {r["doc_id"]: r["_q"] for r in quality.judged(df).collect()}
    assert [i for i in texts if rows[i]["kept"]] == [1, 8]
    for i, t in texts.items():
        w = (t or "").split()
        assert (rows[i]["n_words"], rows[i]["word_chars"], rows[i]["n_repeat_words"]) == (len(w), sum(map(len, w)), repeated(w))
    assert rows[8]["n_dup_lines"] == 1 and "All rights" in rows[8]["cleaned"]
    out = quality.clean(df)
    assert out.columns == df.columns and out.count() == 2
    assert quality.clean(df.limit(0)).count() == 0


def test_quality_keeps_clean_texts_of_any_script_and_line_length(spark):
    def prose(letters, n=200):
        rng = random.Random(3)
        return ["".join(rng.choices(letters, k=5)) for _ in range(n)]

    def lines(words):
        return "\n".join(" ".join(words[i : i + 20]) + "." for i in range(0, len(words), 20))

    one = prose("abcdéèçh", 2000)
    quoted = " ".join(one[:500] + ["«", "mot", "»"] * 4 + one[500:] + ["|"] * 3)
    kept = {
        "arabic": lines(prose("ابتثجحخد")), "hebrew": lines(prose("אבגדהוזח")), "hindi": lines(prose("कखगघचछजझ")), "korean": lines(prose("가나다라마바사아")),
        "acronyms": lines([w if i % 4 else "WHO" + str(i) for i, w in enumerate(prose("ابتثجحخد"))]), "french": quoted, "opening": "Click here to " + " ".join(one),
    }
    lost = {"loud": lines(prose("ABCDEFГД")), "menu": "\n".join(f"{a} » {b} › {c} • {a}{b}" for a, b, c in zip(one[::3], one[1::3], one[2::3])), "sign": "\n".join(f"Sign in to {w}" for w in one[:200])}
    rows = by_id(quality.judged(frame(spark, list((kept | lost).items()), "doc_id string, text string")))
    assert {i for i, r in rows.items() if r["q"]["kept"]} == set(kept)
    assert {r["q"]["n_failed_lines"] for i, r in rows.items() if i in kept} == {0}


def test_repeated_words_of_very_long_texts(spark, monkeypatch):
    monkeypatch.setattr(quality, "PLACE_BITS", 4)  # more than 15 words: the way for long texts
    rng = random.Random(4)
    texts = [" ".join(rng.choices("abc", k=n)) for n in (2, 3, 15, 16, 17, 80)]
    rows = by_id(quality.judged(frame(spark, list(enumerate(texts)))))
    for i, t in enumerate(texts):
        assert rows[i]["q"]["n_repeat_words"] == repeated(t.split())


# --- 5 ---------------------------------------------------------------------------


def test_katz_in_odd_cases(spark):
    rows = katz.katz_scores(frame(spark, [(None, "a b"), (1, None), (2, ""), (2, ""), (3, "a b a b"), (4, "zz")])).collect()
    assert len(rows) == 6 and all(np.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    assert sorted(r["n_tokens"] for r in rows) == [1, 1, 1, 2, 3, 5]
    assert katz.katz_scores(frame(spark, [])).count() == 0


# --- 6 ---------------------------------------------------------------------------


def test_templates_go_and_prose_stays(spark):
    box = "<div>Our shop is open <b>all</b> day</div>"
    pages = [(i, "http://a.org/x", f"<body>{box}<p>Text {i} one.<p>same paragraph{'' if i else box}<div>tail {i}</div>") for i in range(20)]
    pages += [(100 + i, "http://b.org/x", f"<body>{box}<p>only {i}</p>") for i in range(2)]
    pages += [(200, None, None), (201, "odd", ""), (202, "http://c.org", "<p>a&amp;b&nbsp;<br> c<script>x<p></script>d")]
    rows = by_id(templates.main_text(frame(spark, pages, "page_id long, url string, html string")), "page_id")
    assert rows[3]["text"] == "Text 3 one. tail 3"  # outside an article a paragraph of every page is template too
    assert rows[101]["text"] == "Our shop is open all day only 1"  # two pages are not many
    assert (rows[200]["text"], rows[201]["text"], rows[202]["text"]) == ("", "", "a&b cd")
    articles = [(i, "http://a.org/x", f"<article><h1>T</h1><p>licence text</p>{box}<section class='comments'>x</section></article><div>z") for i in range(20)]
    assert {r["text"] for r in templates.main_text(frame(spark, articles, "page_id long, url string, html string")).collect()} == {"T licence text"}


def test_copies_of_a_page_keep_their_article(spark):
    """An open <b>, wrappers in and around the article, text in bare containers, no article at all."""
    forms = {
        "open": ("<article><h1>T</h1><p>First <b>words here<p>Second part</article>", "T First words here Second part"),
        "wrapped": ("<div><section><article><div><p>One <em>two</em><p>three</div></article></section></div>", "One two three"),
        "bare": ("<article><h1>T</h1><div>One</div><div>two</div></article>", "T One two"),
        "main": ("<main><div>One</div><p>two</main>", "One two"),
        "body": ("<div><p>One</p><div>two</div></div>", "One two"),
    }
    pages = [(f"{k}{i}", f"http://{k}.org/{i}", f"<html><body>{form}</body></html>") for k, (form, _) in forms.items() for i in range(50)]
    # Outside articles: an open inline element does not take the words before it along.
    pages += [(f"inline{i}", f"http://inline.org/{i}", f"<p>Text {i} <b>more<p>rest {i}") for i in range(20)]
    # A container that different articles share is template still.
    pages += [(f"box{i}", f"http://box.org/{i}", f"<article><h1>T {i}</h1><div>Our shop</div></article>") for i in range(20)]
    rows = by_id(templates.main_text(frame(spark, pages, "page_id string, url string, html string")), "page_id")
    assert {i: r["text"] for i, r in rows.items() if i.rstrip("0123456789") in forms} == {f"{k}{i}": text for k, (_, text) in forms.items() for i in range(50)}
    assert rows["inline3"]["text"] == "Text 3 more rest 3" and rows["box3"]["text"] == "T 3"


def test_names_leave_out_no_article(spark):
    forms = [
        '<article class="post comments-open"><p>Text</article>', '<article class="post category-promotion"><p>Text</article>', '<article class="promo"><p>Text</article>',
        '<div class="content has-sidebar"><article><p>Text</article></div>', '<div class="content has-sidebar"><p>Text</div>', '<div id="popup"><section class="related"><article><p>Text</article></section></div>',
        '<form id="page"><article><p>Text</article></form>', '<div class="cookie-banner">no</div><div class="ad">no</div><div id="site-footer">no</div><form>no</form><p>Text</p>',
    ]
    pages = [(i, f"http://h{i}.org/", f"<body>{form}</body>") for i, form in enumerate(forms)]
    assert [r["text"] for r in templates.main_text(frame(spark, pages, "page_id long, url string, html string")).orderBy("page_id").collect()] == ["Text"] * len(forms)


def test_menus_of_a_section_of_a_large_host(spark):
    """Below a tenth of the host's pages, but on a thousand of them."""
    pages = spark.range(11000).selectExpr("id AS page_id", "'http://a.org/' AS url", "concat('<body>', if(id < 1000, '<div>section menu</div>', ''), if(id < 999, '<div>rare</div>', ''), '<p>Text ', id, '</body>') AS html")
    rows = by_id(templates.main_text(pages).filter("page_id IN (5, 5000)"), "page_id")
    assert (rows[5]["text"], rows[5000]["text"]) == ("rare Text 5", "Text 5000")


def test_deep_pages_take_time_and_room_in_proportion():
    """Elements left open by the ten thousand: a block names one element, not all around it."""
    for unit, blocks in (("<div>a", 100_000), ("<div><p>a", 100_000), ("<ul><li>a", 30_000), ("<table><tr><td>a", 20_000)):
        found, trees, ends, _ = templates.cut(unit * blocks)
        assert len(found) == blocks and len(trees) == len(ends) == unit.count("<") * blocks
        assert all(k <= end < len(trees) for k, end in enumerate(ends))
    found, _, _, _ = templates.cut("<main><article>" + "<div class='sidebar'>" * 20_000 + "<p>text")
    assert [t for t, _ in found] == []


def test_odd_tables_of_pages(spark):
    """No rows; repeated ids and urls; columns named like the operator's own; a page of many open elements."""
    assert templates.main_text(frame(spark, [], "page_id long, url string, html string")).count() == 0
    deep = "<div>" * 3000 + "<p>deep</p>"
    rows = [(1, "http://h/a", "<p>one</p>", "x", 1)] * 2 + [(1, "http://h/a", "<p>two</p>", "y", 2), (None, None, None, None, None), (2, "http://h/b", deep, "", 0)]
    pages = frame(spark, rows, "page_id long, url string, html string, text string, blocks int")
    got = sorted(((r["page_id"], r["text"]) for r in templates.main_text(pages).collect()), key=repr)
    assert got == sorted([(1, "one"), (1, "one"), (1, "two"), (None, ""), (2, "deep")], key=repr)


# --- 7 ---------------------------------------------------------------------------


def classes(texts, percent=75):
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("hot, few, rounds", [(jaccard.HOT, jaccard.FEW, jaccard.ROUNDS), (5, 0, (1, 2)), (50, 0, (1, 1, 1, 4))])
def test_jaccard_against_all_pairs(spark, monkeypatch, hot, few, rounds):
    """Groups of near copies, shared passages, short texts; also with every frequent column salted and
    with rounds of few partners."""
    monkeypatch.setattr(jaccard, "FEW", few)
    monkeypatch.setattr(jaccard, "ROUNDS", rounds)
    monkeypatch.setattr(jaccard, "CHAINS", 1)
    rng = random.Random(5)
    vocabulary = [f"v{i}" for i in range(300)]
    passage = rng.choices(vocabulary, k=60)
    texts, n = {}, 0
    for _ in range(25):
        words = rng.choices(vocabulary, k=rng.randint(3, 120))
        for _ in range(rng.choice([1, 1, 3, 12])):
            copy = [rng.choice(vocabulary) if rng.random() < rng.choice([0, 0.01, 0.03, 0.06]) else w for w in words]
            texts[n] = " ".join(copy + (passage if rng.random() < 0.4 else []))
            n += 1
    texts |= {n: None, n + 1: "", n + 2: " \n", n + 3: "One", n + 4: "one", n + 5: "\x1cone", n + 6: "one two", n + 7: "one two"}
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(frame(spark, list(texts.items())), hot=hot).collect()}
    assert got == {i: v for i, v in classes(texts).items()}


def test_jaccard_across_the_salts_of_a_column(spark):
    """Many copies of a text, one node, make its columns hot; in a variant a quarter longer they are all late."""
    rng, texts = random.Random(6), {}
    for k in range(6):
        words = [f"t{k}w{i}" for i in range(300)]
        for _ in range(60):
            texts[len(texts)] = " ".join(words)
        texts[len(texts)] = " ".join(words + [f"new{k}x{rng.random()}" for _ in range(80)])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(frame(spark, list(texts.items())), hot=5).collect()}
    assert got == classes(texts)
    assert {i: c for i, (_, c) in got.items()} == {i: i // 61 * 61 for i in texts}


@pytest.mark.parametrize("changed, growth", [(0.01, 2), (0.02, 3)])
def test_pairs_of_a_group_grow_in_proportion(spark, monkeypatch, changed, growth):
    """Four times the copies of a text: not sixteen times the pairs, and the same classes as from all. Of looser
    copies some link with none; only these meet all others that the bounds let through."""
    made, checked = [], jaccard._links
    monkeypatch.setattr(jaccard, "_links", lambda docs, pairs, *rest: made.append(pairs.count()) or checked(docs, pairs, *rest))
    rng = random.Random(8)
    words, each = [f"w{i}" for i in range(200)], []
    for size in (100, 400):
        texts = {i: " ".join(f"x{i}y{k}" if rng.random() < changed else w for k, w in enumerate(words)) for i in range(size)}
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(frame(spark, list(texts.items()))).collect()}
        assert got == classes(texts)
        each.append(sum(made) / size)
        made.clear()
    assert each[1] <= growth * each[0]


def test_jaccard_of_little(spark):
    assert jaccard.near_duplicates(frame(spark, [])).count() == 0
    assert [r["component_id"] for r in jaccard.near_duplicates(frame(spark, [(None, "a"), (None, "a")])).collect()] == [None, None]


def test_one_row_of_each_group(spark):
    """Repeated rows, an id of two texts, the same text under several ids and under none."""
    a, b, c = (" ".join(f"{k}{i}" for i in range(60)) for k in "abc")
    rows = [(1, a, "en", "s", 1)] * 3 + [(2, a, "en", "s", 1), (2, b, "en", "s", 1), (3, b, "en", "s", 1), (4, c, "en", "s", 1), (4, c, "de", "s", 1), (None, c, None, None, 1), (5, "", "en", "s", 1), (5, "", "en", "s", 1), (6, None, "en", "s", 1), (7, a + " more", "en", "s", 1)]
    out = corpus_pipeline.one_of_each_group(spark, frame(spark, rows, DOCS), "")
    assert out.columns == [c.split()[0] for c in DOCS.split(", ")]
    assert sorted((r["doc_id"], r["text"]) for r in out.collect() if r["text"]) == [(1, a), (2, b), (4, c)]
    assert sorted(r["doc_id"] for r in out.collect() if not r["text"]) == [5, 6]


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 2000), (2000, 1000), (5, 5)]
    got = {r["node"]: r["label"] for r in components(frame(spark, edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(301)} | {1000: 1000, 2000: 1000}


def test_word_hashes_across_chunks(monkeypatch):
    monkeypatch.setattr(hashing, "CHUNK", 64)
    tables = hashing.Tables()
    texts = ["a b c d e f", None, "", "B C D E F", "x " * 200, "\ta\nb\x0bc d  E"]
    sets = dict(hashing.shingle_sets(pa.array(texts), 5, tables))
    assert [len(sets[i]) for i in range(6)] == [2, 0, 0, 1, 1, 1]
    assert set(sets[3]) < set(sets[0]) and set(sets[5]) < set(sets[0])


# --- 8 ---------------------------------------------------------------------------


def test_mixing_reaches_the_target(spark):
    rows = [(i, "t", "en", "big" if i % 10 else "small", 1) for i in range(20000)] + [(90000 + i, None, None, None, None) for i in range(100)]
    docs = frame(spark, rows, DOCS).withColumn("copy", F.lit("mine"))
    rates = mixing.target_rates(docs, "source", {"big": 1, "small": 1}, default_weight=0)
    out = mixing.replicate(docs, rates)
    assert out.columns == [*docs.columns, "_copy", "draw"]
    n = {r["source"]: r["n"] for r in out.groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert None not in n and abs(n["big"] / n["small"] - 1) < 0.06
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, mixing.replicate(docs, rates).collect()))


def test_counts_are_poisson_also_beyond_one_inversion(spark):
    docs = frame(spark, [(i, "t", "en", "s", 1) for i in range(4000)], DOCS)
    for rate in (0.7, 40.0):
        rates = frame(spark, [("s", rate)], "source string, rate double")
        counts = mixing.replicate(docs, rates).groupBy("doc_id").agg(F.count("*").alias("n")).toPandas()["n"].tolist()
        counts += [0] * (4000 - len(counts))
        assert abs(np.mean(counts) - rate) < 0.05 * rate and abs(np.var(counts) / rate - 1) < 0.12
    assert mixing.replicate(docs.limit(0), mixing.target_rates(docs.limit(0), "source")).count() == 0


# --- 9 ---------------------------------------------------------------------------


def test_tool_calls_are_linked_ordered_and_checked(spark):
    def call(i, name="add", arguments='{"b": 2, "a": {"y": 1, "x": [true, null]}}', after=()):
        return {"id": i, "name": name, "arguments": arguments, "after": list(after)}

    said = [
        (1, 0, "assistant", json.dumps({"tool_calls": [call("c", after=["b"]), call("b", after=["a"]), call("a")]})),
        (1, 1, "tool", json.dumps({"tool_call_id": "a", "content": "é\"1\""})),
        (1, 2, "tool", json.dumps({"tool_call_id": "a", "content": "late"})),
        (1, 3, "tool", json.dumps({"tool_call_id": "zz", "content": "lost"})),
        (2, 0, "assistant", json.dumps({"tool_calls": [call("p", after=["q"]), call("q", after=["p", "none"]), call("bad", arguments="[1]"), call("who", name="other")]})),
        (3, 0, "user", "hi"), (3, 1, "assistant", "hello"), (3, 2, "user", ""), (3, 3, "user", None), (3, 5, "assistant", "stray"),
    ]
    schemas = frame(spark, [("add", "a", "object", True, None), ("add", "b", "integer", True, 3.0), ("add", "c", "string", False, None), *toolcalls.REPLY], "name string, param string, type string, required boolean, least double")
    calls, results = toolcalls.calls_of(frame(spark, said, "conv_id long, turn long, role string, text string").withColumn("level", F.lit("x")))
    rows = {(r["conv_id"], r["call_id"]): r for r in toolcalls.link(calls, results, schemas).collect()}
    assert len(rows) == 10
    assert [rows[1, c]["level"] for c in "abc"] == [0, 1, 2] and [rows[2, c]["level"] for c in "pq"] == [-1, -1]
    assert [rows[k]["status"] for k in ((1, "a"), (1, "b"), (1, "zz"), (3, "turn-0"), (3, "turn-2"))] == ["linked", "open", "orphan", "linked", "open"]
    a = rows[1, "a"]["json"]
    assert json.loads(a) == {"arguments": {"a": {"x": [True, None], "y": 1}, "b": 2}, "errors": ["small:b"], "id": "a", "name": "add", "result": 'é"1"', "status": "linked"}
    assert a == json.dumps(json.loads(a), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert json.loads(rows[2, "bad"]["json"])["errors"] == ["not an object"]
    assert json.loads(rows[2, "who"]["json"])["errors"] == ["unknown tool"]
    assert "unknown call:none" in json.loads(rows[2, "q"]["json"])["errors"]
    assert json.loads(rows[3, "turn-2"]["json"])["errors"] == ["small:prompt"]
    empty = toolcalls.calls_of(frame(spark, [], "conv_id long, turn long, role string, text string"))
    assert toolcalls.link(*empty, schemas).count() == 0


def test_messages_that_only_look_like_calls(spark):
    answers = ['{"price": 3}', '{ not json', '{"tool_calls": []}', '{"tool_calls": null}', '{"tool_call_id": "a"}']
    said = [(k, t, r, x) for k, a in enumerate(answers) for t, r, x in ((0, "user", "ask"), (1, "assistant", a))]
    loose = ["plain result", '{"content": "no id"}', "{broken", "plain result", '["a"]']
    said += [(9, k, "tool", x) for k, x in enumerate(loose)]
    calls, results = toolcalls.calls_of(frame(spark, said, "conv_id long, turn long, role string, text string"))
    rows = {(r["conv_id"], r["turn"]): r for r in toolcalls.link(calls, results, toolcalls.reply_schema(spark)).collect()}
    assert len(rows) == len(answers) + len(loose)
    for k, a in enumerate(answers):
        assert rows[k, 0]["status"] == "linked" and json.loads(rows[k, 0]["json"])["result"] == a
    for k, x in enumerate(loose):
        r = rows[9, k]
        assert (r["status"], r["call_id"], json.loads(r["json"])["result"]) == ("orphan", None, x)


# --- 10 --------------------------------------------------------------------------


@pytest.mark.parametrize("row_calls", [toolcalls.ROW_CALLS, 0])
def test_levels_in_a_row_and_over_tables(spark, monkeypatch, row_calls):
    """Diamonds, circles, what comes after them, and names of calls that do not exist."""
    monkeypatch.setattr(toolcalls, "ROW_CALLS", row_calls)
    after = {"a": ["b", "c"], "b": ["d"], "c": ["d", "b"], "d": [], "e": ["f"], "f": ["e"], "g": ["e", "a"], "h": ["none"], "i": ["i"]}
    calls = frame(spark, [(k, i, 0, name, first) for k in (1, 2) for i, (name, first) in enumerate(after.items())], "conv_id int, turn int, place int, call_id string, after array<string>")
    got = {(r["conv_id"], r["call_id"]): r["level"] for r in toolcalls._levels(calls).collect()}
    want = {"a": 3, "b": 1, "c": 2, "d": 0, "e": -1, "f": -1, "g": -1, "h": 0, "i": -1}
    assert got == {(k, name): level for k in (1, 2) for name, level in want.items()}


def test_a_long_chain_in_reverse(spark):
    """A thousand calls, each naming the next: no round of tables per level."""
    calls = frame(spark, [(1, i, 0, f"c{i}", [f"c{i + 1}"] if i < 999 else []) for i in range(1000)], "conv_id int, turn int, place int, call_id string, after array<string>")
    got = {r["call_id"]: r["level"] for r in toolcalls._levels(calls).collect()}
    assert got == {f"c{i}": 999 - i for i in range(1000)}


def test_archives_round_trip(spark, tmp_path):
    body = "x" * 100
    pages = [(5, "u", body), (3, "u", body), (9, None, body), (1, "u\r\nX: y", "short"), (2, "u", "short"), (7, "é", None), (None, "n", body), (3, "u", body), (8, "u", "\r\n\r\nWARC/1.1\r\n" * 20)]
    rows = [tuple(r) for r in archives.round_trip(spark, frame(spark, [(*p, 1) for p in pages], "page_id long, url string, html string, payload int")).select("page_id", "payload_bytes", "record_type", "refers_to").collect()]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(rows, key=key) == [(1, 5, "response", None), (2, 5, "response", None), (3, 100, "response", None), (3, 100, "response", None), (5, 100, "revisit", 3), (7, 0, "response", None), (8, 280, "response", None), (9, 100, "revisit", 3), (None, 100, "revisit", 3)]
    assert archives.round_trip(spark, frame(spark, [], "page_id long, url string, html string")).count() == 0


def test_packages_are_zip_files_and_many_are_read(spark, tmp_path):
    pages = frame(spark, [(i, f"http://h/{i}", f"<p>{'é' * i}") for i in range(300)], "page_id long, url string, html string")
    folder = f"file://{tmp_path}/packages"
    packages = archives.write_packages(archives.typed(pages), folder, package_bytes=4000)
    paths = [r["path"] for r in packages.collect()]
    assert len(paths) > 5
    with zipfile.ZipFile(paths[0]) as z:
        assert z.testzip() is None and set(z.namelist()) == {archives.DATA, archives.INDEX}
        assert all(i.compress_type == zipfile.ZIP_STORED for i in z.infolist())
    back = {r["page_id"]: r["payload"] for r in archives.read_packages(packages, folder, pages.schema["page_id"].dataType).collect()}
    assert back == {i: f"<p>{'é' * i}".encode() for i in range(300)}


def test_records_have_the_fields_the_format_asks_for(spark, tmp_path):
    """A date, an id of their own even where id, url and payload repeat, and for revisits what they refer to."""
    body = "x" * 200
    pages = frame(spark, [(1, "http://h/1", body)] * 3 + [(2, "http://h/2", body), (3, "http://h/3", "short")], "page_id long, url string, html string")
    folder = f"file://{tmp_path}/packages"
    paths = [r["path"] for r in archives.write_packages(archives.typed(pages), folder).collect()]
    records = []
    for path in paths:
        with zipfile.ZipFile(path) as z:
            text = gzip.decompress(z.read(archives.DATA))
        while text:
            fields, _ = archives.parse(text)
            size = text.index(b"\r\n\r\n") + 4 + int(fields["Content-Length"]) + 4
            records.append(fields)
            text = text[size:]
    assert len(records) == 5 and len({r["WARC-Record-ID"] for r in records}) == 5
    assert all(re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", r["WARC-Date"]) for r in records)
    assert [(r["WARC-Refers-To-Target-URI"], r["WARC-Refers-To-Date"]) for r in records if r["WARC-Type"] == "revisit"] == [("http://h/1", records[0]["WARC-Date"])]


def test_zip64_directories():
    """Entries whose sizes and places stand in the ZIP64 fields, behind a ZIP64 end record."""
    data = b"payload"
    local = struct.pack("<4sHHHHHIIIHH", b"PK\x03\x04", 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, 1, 20) + b"m" + struct.pack("<HHQQ", 1, 16, 7, 7) + data
    entry = struct.pack("<4sHHHHHHIIIHHHHHII", b"PK\x01\x02", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, 1, 28, 0, 0, 0, 0, 0xFFFFFFFF) + b"m" + struct.pack("<HHQQQ", 1, 24, 7, 7, 0)
    at = len(local) + len(entry)
    end64 = struct.pack("<4sQHHIIQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, 1, 1, len(entry), len(local))
    file = local + entry + end64 + struct.pack("<4sIQI", b"PK\x06\x07", 0, at, 1) + struct.pack("<4sHHHHIIH", b"PK\x05\x06", 0xFFFF, 0xFFFF, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    start, length = archives.members(io.BytesIO(file), len(file))["m"]
    assert file[start : start + length] == data
    with pytest.raises(ValueError):
        archives.members(io.BytesIO(b"none"), 4)
