"""Main text of web pages: site templates go by subtrees that recur across a host's pages.

Every page is cut once into text blocks and element subtrees. A subtree's hash covers its tags and
text. Spark counts, per host, in how many different contents (the texts of a page's articles, or else of its
main element or body) each hash occurs: copies of a page have one vote. A subtree that recurs in at least
``min_pages`` contents and ``share`` of the host's contents, or in ``enough`` contents however many the host
has, is template and is deleted with all blocks below it. A block is below the elements that hold all of its text.
Inside an article, paragraphs and headings are prose and stay although copies of an article repeat
them, and so do inline elements and all that holds prose or an article; only other containers there can be
template. Beside paragraphs such a container is judged over pages as well, copies included.

What a menu, header, footer, form, notice, advert, sidebar or comment says may differ from page to
page, so elements that are one by tag, role or class are left out in the cut already. A class or id counts as a whole
name, all of whose parts say so, and neither it nor the tag ``form`` leaves out what is or holds an article. Blocks come
from the page's articles, or its main element, or, without either, its body.

The cut runs inside tasks, page by page, in time and memory in proportion to the page: elements are
numbered as they open, so a subtree is a range of numbers and a block needs only the number of the
innermost element that holds it. Counting, joining and joining up are Spark's.

Defined results: a null or empty html gives an empty text; a null or odd url belongs to host ""; pages
that share an id and html get equal results each; unclosed tags end with their parent; an empty table
gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
import html as markup
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from demandtide.llm import base

#: Recurring subtrees up to which their table is broadcast.
BROADCAST_SUBTREES = 100_000

# Element names by what they are for.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe xmp noembed noframes".split())
LEFT_OUT = RAW | frozenset("head nav footer aside form button select option datalist dialog menu svg math canvas object audio video map".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul caption".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li ul ol dl dt dd table tbody thead tr td th figcaption".split())
NOTE_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog toolbar".split())
NOTE_CLASSES = frozenset("ad ads advert adverts advertisement advertising adsbygoogle sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead comment comments commentlist disqus respond replies reply share sharing social related recommended widget toolbar pagination pager skip".split())
#: Parts of names beside those.
PLACES = frozenset("site page main top bottom header".split())
# A start tag of the first kind ends an open element of the second, not looking beyond the third.
CLOSES = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select",))}

TAG = re.compile(r"<(?:!--(?P<note>.*?)(?:-->|\Z)|(?P<bang>[!?])[^>]*(?:>|\Z)|(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<more>(?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)(?:>|\Z))", re.S)
NAMED = re.compile(r"([^\s=\"'/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")


def _is_note(name: str, more: str, in_article: bool, holds: bool) -> tuple[bool, bool]:
    """Whether an element is something other than the article, by its name or attributes; and whether
    only its class, its id or the tag ``form`` says so, which those that hold an article are spared."""
    if name in LEFT_OUT and name != "form" or (name == "header" and not in_article):
        return True, False
    known = {}
    if more and not more.isspace():
        known = {k.lower(): (a or b or c or "") for k, a, b, c in NAMED.findall(more)}
        if re.search(r"(?:^|\s)hidden(?:\s|$)", NAMED.sub(" ", more)) or known.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", known.get("style", "")):
            return True, False
        if known.get("role", "").lower() in NOTE_ROLES:
            return True, False
    if holds or name in ("html", "body", "main", "article"):
        return False, False
    if name == "form":
        return True, True
    for whole in (known.get("class", "") + " " + known.get("id", "")).lower().split():
        parts = set(re.split(r"[^a-z0-9]+", whole)) - {""}
        if parts <= NOTE_CLASSES | PLACES and (parts & NOTE_CLASSES or (not in_article and "header" in parts)):
            return True, True
    return False, False


def cut(page: str, spared: frozenset[int] = frozenset()) -> tuple[list[tuple[str, int]], list[int | None], list[int], list[int]]:
    """Blocks (text, number of the innermost element around all of it, -1 for none) in page order, the
    subtrees' hashes (None where a subtree can't be template), the last number inside each, and the
    hashes of containers beside an article's paragraphs. Where a name has left out an article, the page
    is cut again with the numbers ``spared`` of the elements that hold it."""
    blocks: list[tuple[str, int, int]] = []  # text, region, innermost element
    hashes: list[int] = []
    ends: list[int] = []
    eligible: list[bool] = []
    stack: list[list] = []  # name, number, hash state, region, note, holds prose
    open_: Counter[str] = Counter()  # names of the open elements
    words: list[str] = []
    depth, blank = 0, True  # elements that hold all of the words, no word yet
    inside: list[int] = []  # subtrees inside articles
    paragraphs = False
    soft: list[int] = []  # open elements left out by a mere name
    holders: set[int] = set()  # those of them that hold an article

    def flush() -> None:
        nonlocal blank
        blank = True
        text = " ".join(markup.unescape("".join(words)).split())
        words.clear()
        if text and not (stack and stack[-1][4]):
            blocks.append((text, stack[-1][3] if stack else 0, stack[depth - 1][1] if depth else -1))

    def pop() -> None:
        nonlocal depth
        name, number, state, _, _, prose = stack[-1]
        if name in BLOCKS:
            flush()
        stack.pop()
        open_[name] -= 1
        ends[number] = len(hashes) - 1
        if soft and soft[-1] == number:
            soft.pop()
        # What holds prose is no template, and so is all around it.
        if prose and stack:
            stack[-1][5] = True
            eligible[stack[-1][1]] = False
        depth = min(depth, len(stack))
        digest = state.digest()
        hashes[number] = int.from_bytes(digest, "big", signed=True)
        if stack:
            stack[-1][2].update(b"<" + name.encode() + digest)

    def add(text: str) -> None:
        nonlocal depth, blank
        if text:
            if blank:
                depth, blank = len(stack), text.isspace()
            words.append(text)
            if stack:
                stack[-1][2].update(" ".join(text.split()).encode("utf-8", "replace"))

    at, size = 0, len(page)
    while at < size:
        m = TAG.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        if m["name"] is None:
            continue
        name = m["name"].lower()
        if m["end"]:
            if open_[name] > 0:
                while stack[-1][0] != name:
                    pop()
                pop()
            elif name in BLOCKS:
                flush()
            continue
        if name == "br":
            add(" ")
        if name in VOID:
            if name == "hr":
                flush()
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\b[^>]*>?", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if name in BLOCKS:
            flush()
            # A block ends an open paragraph.
            if open_["p"] > 0:
                while stack[-1][0] != "p":
                    pop()
                pop()
        if name in CLOSES:
            ended, wall = CLOSES[name]
            if any(open_[x] > 0 for x in ended):
                place = next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] in ended or stack[i][0] in wall)
                if stack[place][0] in ended:
                    while len(stack) > place:
                        pop()
        up = stack[-1] if stack else ["", 0, None, 0, False, False]
        own, mere = _is_note(name, m["more"], up[3] == 2, len(hashes) in spared)
        note = up[4] or own
        region = max(up[3], 2 if name == "article" else 1 if name == "main" or 'role="main"' in m["more"] else 0)
        if m["more"].rstrip().endswith("/") and name not in BLOCKS:
            continue
        if name == "article":
            holders.update(soft)
            soft.clear()
        if mere:
            soft.append(len(hashes))
        if note and not up[4]:
            flush()
        prose = region == 2 and (name == "article" or (name in PROSE and not note))
        stack.append([name, len(hashes), hashlib.blake2b(name.encode(), digest_size=8), region, note, prose])
        open_[name] += 1
        hashes.append(0)
        ends.append(0)
        eligible.append(name not in ("html", "body", "main", "article") and not (region == 2 and (name in PROSE or name not in BLOCKS)))
        if region == 2:
            inside.append(len(eligible) - 1)
            paragraphs |= name == "p" and not note
    while stack:
        pop()
    flush()
    if holders:
        return cut(page, frozenset(holders))
    best = max((b[1] for b in blocks), default=0)
    kept = [(text, leaf) for text, region, leaf in blocks if region == best]
    return kept, [h if eligible[k] else None for k, h in enumerate(hashes)], ends, [hashes[k] for k in inside if eligible[k]] if paragraphs else []


def _content(blocks: list[tuple[str, int]]) -> int:
    """A hash of the blocks' texts."""
    return int.from_bytes(hashlib.blake2b("\n".join(t for t, _ in blocks).encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", min_pages: int = 5, share: float = 0.1, enough: int = 1000) -> DataFrame:
    """One row per page row: page_id, url, text, n_chars."""
    id_type = pages.schema[page_id].dataType
    block = T.StructType([T.StructField("text", T.StringType()), T.StructField("leaf", T.IntegerType())])
    schema = T.StructType([T.StructField("page_id", id_type), T.StructField("url", T.StringType()), T.StructField("host", T.StringType()), T.StructField("blocks", T.ArrayType(block)), T.StructField("trees", T.ArrayType(T.LongType())), T.StructField("ends", T.ArrayType(T.IntegerType())), T.StructField("beside", T.ArrayType(T.LongType())), T.StructField("content", T.LongType())])
    host = F.coalesce(F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    read = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), host.alias("host"), F.col(html).alias("html"))

    def run(batches):
        arrow = to_arrow_schema(schema)
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                cuts = [cut(x.as_py() or "") for x in part.column("html")]
                blocks = [[{"text": t, "leaf": k} for t, k in b] for b, *_ in cuts]
                lists = [pa.array([x[k] for x in cuts], arrow.field(c).type) for k, c in ((1, "trees"), (2, "ends"), (3, "beside"))]
                yield pa.RecordBatch.from_arrays([*[part.column(c).cast(arrow.field(c).type) for c in ("page_id", "url", "host")], pa.array(blocks, arrow.field("blocks").type), *lists, pa.array([_content(b) for b, *_ in cuts], pa.int64())], schema=arrow)

    cuts = base.kept(read.mapInArrow(run, schema), "page-cuts")
    sizes = cuts.groupBy("host", "content").agg(F.count("*").alias("n")).groupBy("host").agg(F.count("*").alias("contents"), F.sum("n").alias("pages"))
    each = cuts.select("host", "content", F.explode(F.array_distinct("trees")).alias("tree"), F.array_contains("beside", F.col("tree")).alias("beside")).filter("tree IS NOT NULL")
    votes = each.groupBy("host", "tree", "content").agg(F.count_if("beside").alias("copies"))
    seen = votes.groupBy("host", "tree").agg(F.count("*").alias("n"), F.sum("copies").alias("copies")).filter(F.greatest("n", "copies") >= min_pages)
    many = lambda n, of: (F.col(n) >= min_pages) & (F.col(n) >= F.lit(share) * F.col(of))
    common = many("n", "contents") | (F.col("n") >= max(min_pages, enough))
    recurring = base.kept(seen.join(sizes, "host").filter(common | many("copies", "pages")).select("host", "tree"), "recurring-subtrees")
    # A host has at most max(1 / share, contents / enough) times as many as a page has subtrees.
    by_host = recurring.groupBy(F.col("host").alias("of_host")).agg(F.collect_list("tree").alias("template"))
    if recurring.limit(BROADCAST_SUBTREES + 1).count() <= BROADCAST_SUBTREES:
        by_host = F.broadcast(by_host)
    joined = cuts.join(by_host, F.col("host") == F.col("of_host"), "left")
    # The page's template subtrees, marked once; a block is gone when one's range holds its number.
    joined = joined.withColumn("hits", F.array_intersect("trees", F.coalesce("template", F.array().cast("array<bigint>"))))
    marks = F.when(F.size("hits") > 0, F.filter(F.sequence(F.lit(0), F.size("trees") - 1), lambda k: F.array_contains("hits", F.get("trees", k)))).otherwise(F.array().cast("array<int>"))
    joined = joined.withColumn("marks", marks)
    gone = lambda b: F.exists("marks", lambda k: (k <= b["leaf"]) & (b["leaf"] <= F.get("ends", k)))
    left = F.filter("blocks", lambda b: ~gone(b))
    text = F.array_join(F.transform(left, lambda b: b["text"]), " ")
    return joined.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("bigint"))
