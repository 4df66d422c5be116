"""The operators' queries in DuckDB's SQL, for the tables or, in the pipeline, for a stage's rows."""

from __future__ import annotations

_AZ = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


def decontamination(docs: str) -> str:
    return rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_AZ}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM {docs}),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_AZ}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item, array_to_string(w[i:i + 9], ' ') AS x, least(len(w), 10) AS n
        FROM (SELECT *, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
place AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS x
          FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, place.n, item FROM place JOIN win ON place.x = win.x AND place.n = win.n),
word AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hit) GROUP BY doc_id),
item AS (SELECT doc_id, count(DISTINCT item) AS n_items, sha256(string_agg(DISTINCT item, ',' ORDER BY item)) AS s FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(s, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN word USING (doc_id) LEFT JOIN item USING (doc_id)
"""


def sharding(docs: str, columns: str) -> str:
    hash60 = "CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))), 1, 15) AS BIGINT)"
    return f"""
WITH d AS (SELECT *, row_number() OVER () AS r, {hash60} AS h, CAST(coalesce(strlen(text), 0) AS BIGINT) AS n_bytes FROM {docs}),
p AS (SELECT r, h, n_bytes, k, h >> (60 - k) AS f FROM d, (SELECT unnest(generate_series(0, 40)) AS k)),
s AS (SELECT k, f, CAST(sum(n_bytes) AS BIGINT) AS shard_bytes FROM p GROUP BY k, f HAVING sum(n_bytes) <= 1048576 OR min(h) = max(h)),
depth AS (SELECT r, min(k) AS k FROM p JOIN s USING (k, f) GROUP BY r)
SELECT {columns}, substr(lpad(bin(d.h), 60, '0'), 1, CAST(depth.k AS INTEGER)) AS shard, shard_bytes, shard_bytes > 1048576 AS oversized
FROM d JOIN depth USING (r) JOIN s ON s.k = depth.k AND s.f = d.h >> (60 - depth.k)
"""


def quality(docs: str) -> str:
    chars = r"len(regexp_replace({}, '[\x20\x09-\x0D]+', '', 'g'))"
    boilerplate = r"^\s*(accept (all )?cookies|this (web)?site uses cookies|subscribe to our newsletter|share (this )?on (facebook|twitter|x)\b|click here to|sign (in|up) (to|for)|skip to (main )?content|back to top|javascript (is|must be))"
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS.format("coalesce(text, '')")} AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM {docs}),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS x FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM d WHERE len(w) > 2)),
twice AS (SELECT doc_id, x FROM win GROUP BY doc_id, x HAVING count(*) > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM win JOIN twice USING (doc_id, x)) GROUP BY doc_id),
line AS (SELECT doc_id, x, {_WORDS.format("x")} AS v FROM (SELECT doc_id, unnest(list_distinct(lines)) AS x FROM d)),
figure AS (SELECT *, len(v) AS n, len(list_filter(v, lambda y: regexp_matches(y, '[#*$%&|<>]'))) + len(list_filter(v, lambda y: regexp_matches(y, '[!?][!?]$'))) AS marked,
                  len(list_filter(v, lambda y: regexp_matches(y, '\p{{L}}'))) AS letters, len(list_filter(v, lambda y: regexp_matches(y, '\p{{Lu}}'))) AS upper,
                  len(regexp_extract_all(x, '[|]')) AS bars, len(regexp_extract_all(x, '[»›•]')) AS arrows,
                  len(regexp_extract_all(regexp_extract(lower(x), '{boilerplate}'), '[^\x20\x09-\x0D]+')) AS stock FROM line),
good AS (SELECT doc_id, sum({chars.format("x")}) AS left_chars, count(*) AS n FROM figure
         WHERE NOT (marked * 5 > n OR (bars >= 3 AND bars * 10 > n) OR (arrows >= 3 AND arrows * 10 > n)
                    OR (n <= 3 AND (arrows > 0 OR regexp_matches(x, '[|:][\x20\x09-\x0D]*$')))
                    OR (NOT regexp_matches(x, '\p{{Ll}}') AND ((letters >= 4 AND upper = letters) OR (letters = 0 AND n >= 3)))
                    OR (stock > 0 AND stock * 10 >= n)) GROUP BY doc_id),
base AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST({chars.format("t")} AS BIGINT) AS word_chars,
                CAST(len(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
                coalesce(rep.n, 0) AS n_repeat_words, CAST(len(lines) - coalesce(good.n, 0) AS BIGINT) AS n_failed_lines, CAST(coalesce(left_chars, 0) AS BIGINT) AS left_chars
         FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN good USING (doc_id)),
failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, word_chars - left_chars AS lost_chars FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 2 * lost_chars <= word_chars AS kept, n_failed_lines, lost_chars FROM failed
"""


def jaccard(docs: str) -> str:
    return rf"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(_AZ)} AS w FROM {docs}),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS x FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (SELECT a.doc_id AS x, b.doc_id AS y FROM s AS a JOIN s AS b ON a.x = b.x AND a.doc_id <> b.doc_id JOIN n AS na ON na.doc_id = a.doc_id JOIN n AS nb ON nb.doc_id = b.doc_id
          GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 75 * (na.n + nb.n - count(*))),
reach(x, y) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(y) FROM reach WHERE reach.x = d.doc_id) AS component_id FROM d LEFT JOIN n USING (doc_id)
"""


def mixing(docs: str) -> str:
    u = "CAST(CAST('0x' || substr(md5({}), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0"
    return f"""
WITH RECURSIVE size AS (SELECT source, CAST(count(*) AS DOUBLE) AS n FROM {docs} GROUP BY source),
total AS (SELECT sum(pow(n, 0.5)) AS w, sum(n) AS n FROM size),
rate AS (SELECT source, r, greatest(CAST(ceil(r / 16.0) AS INTEGER), 1) AS parts
         FROM (SELECT source, pow(size.n, 0.5) / total.w * total.n / size.n AS r FROM size, total)),
term AS (SELECT source, 0 AS k, exp(-(r / parts)) AS p, exp(-(r / parts)) AS c FROM rate
         UNION ALL
         SELECT term.source, k + 1, p * (r / parts) / (k + 1), c + p * (r / parts) / (k + 1)
         FROM term JOIN rate ON term.source IS NOT DISTINCT FROM rate.source WHERE k < 80),
draws AS (SELECT d.*, {u.format("CAST(doc_id AS VARCHAR) || ':mix:' || CAST(j AS VARCHAR)")} AS u
          FROM (SELECT t.*, unnest(generate_series(1, parts)) AS j FROM {docs} AS t JOIN rate ON t.source IS NOT DISTINCT FROM rate.source) AS d),
times AS (SELECT doc_id, any_value(draws.text) AS text, any_value(lang) AS lang, any_value(draws.source) AS source, any_value(n_chars) AS n_chars, count(term.k) AS n
          FROM draws LEFT JOIN term ON draws.source IS NOT DISTINCT FROM term.source AND term.c <= draws.u GROUP BY doc_id)
SELECT doc_id, text, lang, source, n_chars, CAST(copy AS INTEGER) AS copy, {u.format("CAST(doc_id AS VARCHAR) || ':mix:order:' || CAST(copy AS VARCHAR)")} AS draw
FROM (SELECT *, unnest(generate_series(1, n)) AS copy FROM times WHERE n > 0)
"""


OP9 = """
WITH u AS (SELECT * FROM conversations WHERE role = 'user' AND text IS NOT NULL),
a AS (SELECT conv_id, turn - 1 AS turn, min(text) AS content FROM conversations WHERE role = 'assistant' AND text IS NOT NULL GROUP BY conv_id, turn),
c AS (SELECT u.*, content, CASE WHEN content IS NULL THEN 'open' ELSE 'linked' END AS status, text = '' AS small FROM u LEFT JOIN a USING (conv_id, turn))
SELECT conv_id, 0 AS level, turn, 0 AS place, 'turn-' || turn AS call_id, 'reply' AS name, status, CAST(small AS BIGINT) AS n_errors,
       '{"arguments":{"prompt":' || CAST(to_json(text) AS VARCHAR) || ',"turn":' || turn || '},"errors":[' || CASE WHEN small THEN '"small:prompt"' ELSE '' END || '],"id":"turn-' || turn
       || '","name":"reply","result":' || coalesce(CAST(to_json(content) AS VARCHAR), 'null') || ',"status":"' || status || '"}' AS json
FROM c
"""

OP10 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p WHERE strlen(h) >= 100 GROUP BY h)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (h)
"""

#: Every order played through, filter by filter.
OP12 = r"""
WITH RECURSIVE t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS x FROM documents),
w AS (SELECT *, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS v, min(doc_id) OVER (PARTITION BY x) AS least FROM t),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
             CASE WHEN len(v) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(v)) < 80 * len(v) THEN 'B' ELSE '' END
             || CASE WHEN 100 * len(regexp_replace(x, '[^A-Z]+', '', 'g')) > 10 * len(x) THEN 'C' ELSE '' END
             || CASE WHEN regexp_matches(x, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN doc_id > least THEN 'E' ELSE '' END AS fails
      FROM w LEFT JOIN l USING (doc_id)),
c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY part, fails),
o(filter_order) AS (SELECT '' UNION ALL SELECT filter_order || x FROM o, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) WHERE NOT contains(filter_order, x)),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS own, substr(filter_order, 1, step - 1) AS before
      FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step) WHERE len(filter_order) = 5),
g AS (SELECT part, filter_order, step, own, n, good, toxic, fails = own AS alone, contains(fails, own) AS hit,
             before <> '' AND regexp_matches(fails, '[' || CASE WHEN before = '' THEN '-' ELSE before END || ']') AS gone FROM c, s),
r AS (SELECT part, filter_order, step, own, CAST(coalesce(sum(n) FILTER (NOT gone AND NOT hit), 0) AS BIGINT) AS kept,
             CAST(coalesce(sum(n) FILTER (NOT gone AND hit), 0) AS BIGINT) AS removed, CAST(coalesce(sum(n) FILTER (gone AND hit), 0) AS BIGINT) AS redundant,
             CAST(coalesce(sum(n) FILTER (alone), 0) AS BIGINT) AS unique_fails, CAST(coalesce(sum(good) FILTER (NOT gone AND hit), 0) AS BIGINT) AS good_lost,
             CAST(coalesce(sum(toxic) FILTER (NOT gone AND hit), 0) AS BIGINT) AS toxic_lost FROM g GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM r
"""

OP13 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT row_number() OVER () AS q, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
tf AS (SELECT r, doc_id, len(w) AS n, term, count(*) AS tf FROM (SELECT r, doc_id, w, unnest(w) AS term FROM d) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
a AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
q AS (SELECT q, item_id, term, count(*) AS times FROM (SELECT q, item_id, unnest(w) AS term FROM i) GROUP BY ALL),
s AS (SELECT q, item_id, r, doc_id, CAST(sum(times * CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score
      FROM q JOIN df USING (term) JOIN tf USING (term), a GROUP BY q, item_id, r, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 20
"""

#: Quality rules, one document of each near-copy class, no benchmark passages, mixing, shards.
PIPELINE = f"""
WITH q AS ({quality("documents")}),
d1 AS (SELECT documents.* FROM documents JOIN q USING (doc_id) WHERE kept),
j AS ({jaccard("d1")}),
d2 AS (SELECT d1.* FROM d1 JOIN j USING (doc_id) WHERE component_id = doc_id),
c AS ({decontamination("d2")}),
d3 AS (SELECT d2.* FROM d2 JOIN c USING (doc_id) WHERE NOT contaminated),
m AS ({mixing("d3")}),
d4 AS (SELECT doc_id, text, lang, source, n_chars FROM m)
{sharding("d4", "doc_id, text, lang, source, n_chars").strip().replace("WITH d AS", ", d AS", 1)}
"""

ORACLES = {
    "op1_decontamination": decontamination("documents"),
    "op3_sharding": sharding("documents", "doc_id, n_bytes"),
    "op4_quality": quality("documents"),
    "op7_ngram_jaccard": jaccard("documents"),
    "op8_mixing": mixing("documents"),
    "op9_tool_calls": OP9,
    "op10_archives": OP10,
    "op12_filter_audit": OP12,
    "op13_search": OP13,
}
