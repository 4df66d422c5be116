"""Line-first cleaning: judge every line, drop the failed ones, reject documents that lose too much.

Line rules, for lines with a word:

* symbols: words that carry one of ``#*$%&|<>`` and words that end in two or more ``!``/``?`` are
  together more than a fifth of the line's words
* shouting: four or more words with letters, all of them with upper-case and none with lower-case
  ones; scripts without case do not shout
* navigation: three or more separators (``|``, or ``»``, ``›``, ``•``), more than one to ten words, or at
  most three words with a separator of the second kind, or ending in ``|`` or ``:``
* boilerplate: equal to an earlier line, or beginning with a stock phrase of web pages that is at least
  a tenth of its words
* wording: no letter at all in a line of three or more words

A document is rejected when the failed lines hold more than ``max_lost`` of its word characters,
when its base figures fail (fewer than ``min_words`` words, or more than half of the words inside
repeated three-word windows), or when it has no word.

Native: DataFrame functions only; every figure is made inside the row, so nothing is shuffled.

Defined results: a null or wordless text has zero counts, fails and is not kept; repeated rows get
equal results; other columns, also of the same names as the figures, pass through ``clean``
untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandtide.llm import base

# Beginnings of stock lines, lower-case.
BOILERPLATE = r"^\s*(accept (all )?cookies|this (web)?site uses cookies|subscribe to our newsletter|share (this )?on (facebook|twitter|x)\b|click here to|sign (in|up) (to|for)|skip to (main )?content|back to top|javascript (is|must be))"

#: Words of a line to each separator or word of a stock phrase from which on they do not fail it.
SHARE = 10
#: Words of a window whose repetition counts.
REPEAT = 3
#: Bits of a packed window that hold its position; longer documents are sorted as structs.
PLACE_BITS = 24


def _sorted_windows(w: Column, n: int) -> tuple[Column, Column]:
    """Windows of ``n`` words sorted by hash: packed with their position, or, for documents too
    long for that, as structs; the other of the two is null."""
    places = F.sequence(F.lit(0), F.size(w) - n)
    mask = (1 << PLACE_BITS) - 1

    def hashed(i: Column) -> Column:
        return F.xxhash64(*[w[i + k] for k in range(n)])

    narrow = F.sort_array(F.transform(places, lambda i: hashed(i).bitwiseAND(F.lit(~mask)).bitwiseOR(i.cast("bigint"))))
    wide = F.array_sort(F.transform(places, lambda i: F.struct(hashed(i).alias("h"), i.alias("i"))))
    some = F.size(w) >= n
    return F.when(some & (F.size(w) <= mask), narrow), F.when(some & (F.size(w) > mask), wide)


def _repeated_starts(w: Column, narrow: Column, wide: Column, n: int) -> Column:
    """Positions of windows that occur twice or more: equal ones lie side by side in the sorted
    arrays; neighbours of equal hash are compared word by word. Only where different windows share
    a hash is the whole array looked through. All arguments are columns, not expressions, which the
    lambdas would evaluate again for each element."""
    mask = (1 << PLACE_BITS) - 1

    def twins(sorted_: Column, place, hash_) -> Column:
        last = F.size(sorted_) - 1

        def same(x: Column, y: Column) -> Column:
            out = hash_(x) == hash_(y)
            for k in range(n):
                out = out & (w[place(x) + k] == w[place(y) + k])
            return out

        def twin(x: Column, i: Column) -> Column:
            left, right = sorted_[F.greatest(i - 1, F.lit(0))], sorted_[F.least(i + 1, last)]
            collides = ((i > 0) & (hash_(left) == hash_(x))) | ((i < last) & (hash_(right) == hash_(x)))
            anywhere = F.exists(sorted_, lambda y: (place(y) != place(x)) & same(y, x))
            return F.when((i > 0) & same(left, x), True).when((i < last) & same(right, x), True).when(collides, anywhere).otherwise(False)

        return F.array_sort(F.transform(F.filter(sorted_, twin), place))

    few = twins(narrow, lambda x: x.bitwiseAND(F.lit(mask)).cast("int"), lambda x: F.shiftright(x, PLACE_BITS))
    many = twins(wide, lambda x: x["i"], lambda x: x["h"])
    return F.when(narrow.isNotNull(), few).when(wide.isNotNull(), many).otherwise(F.array().cast("array<int>"))


def _covered(starts: Column, n: int) -> Column:
    """Words under windows of ``n`` words from sorted starts."""
    return F.aggregate(
        starts,
        F.struct(F.lit(0).alias("e"), F.lit(0).cast("bigint").alias("c")),
        lambda acc, s: F.struct((s + n).alias("e"), (acc["c"] + n - F.greatest(acc["e"] - s, F.lit(0))).cast("bigint").alias("c")),
        lambda acc: acc["c"],
    )


def failed_line(line: Column) -> Column:
    """Whether a line with a word breaks a line rule (repetition aside).

    Patterns start at a word's first character and never step back, so a line takes time in
    proportion to its length; the costly ones run only where a cheap one has found a character.
    """
    def size(text: Column) -> Column:
        return F.size(F.array_remove(F.split(text, base.SPACE), ""))

    n = size(line)
    marked = F.regexp_count(line, F.lit(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D#*$%&|<>]*+[#*$%&|<>]")) + F.regexp_count(line, F.lit(r"[!?]{2}(?![^\x20\x09-\x0D])"))
    letters = F.regexp_count(line, F.lit(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D\p{L}]*+\p{L}"))
    upper = F.regexp_count(line, F.lit(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D\p{Lu}]*+\p{Lu}"))

    def parted(separator: str) -> Column:
        found = F.regexp_count(line, F.lit(separator))
        return (found >= 3) & (found * SHARE > n)

    low = F.lower(line)
    return (
        F.when(line.rlike(r"[#*$%&|<>]|[!?]{2}"), (marked * 5 > n) | parted(r"[|]")).otherwise(False)
        | F.when(line.rlike(r"[»›•]|[|:]\s*$"), parted(r"[»›•]") | (n <= 3)).otherwise(False)
        | F.when(~line.rlike(r"\p{Ll}"), ((letters >= 4) & (upper == letters)) | ((letters == 0) & (n >= 3))).otherwise(False)
        | F.when(low.rlike(BOILERPLATE), size(F.regexp_extract(low, BOILERPLATE, 0)) * SHARE >= n).otherwise(False)
    )


def judged(docs: DataFrame, text: str = "text", min_words: int = 50, max_lost: float = 0.5, max_repeated: float = 0.5) -> DataFrame:
    """``docs`` with one more column, a struct: ``q`` (underscores in front if taken) of n_words,
    word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, lost_chars, n_failed_lines,
    kept and cleaned (the text without failed lines)."""
    taken = docs.columns
    w, lines, found, narrow, wide, starts, q = (base.column_name(c, taken) for c in ("cut_words", "cut_lines", "good_lines", "windows", "long_windows", "repeats", "q"))
    t = F.coalesce(F.col(text), F.lit(""))
    filled = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = docs.withColumns({w: base.words(t, base.SPACE), lines: filled})
    L = F.col(lines)
    df = df.withColumn(found, F.array_distinct(F.filter(L, lambda x: ~failed_line(x))))
    df = df.withColumns(dict(zip((narrow, wide), _sorted_windows(F.col(w), REPEAT))))
    df = df.withColumn(starts, _repeated_starts(F.col(w), F.col(narrow), F.col(wide), REPEAT))
    chars = F.length(F.regexp_replace(t, base.SPACE, ""))
    left = F.aggregate(F.col(found), F.lit(0), lambda acc, x: acc + F.length(F.regexp_replace(x, base.SPACE, "")))
    n = F.size(w).cast("bigint")
    body = F.struct(
        n.alias("n_words"),
        chars.cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
        (F.size(L) - F.size(F.array_distinct(L))).cast("bigint").alias("n_dup_lines"),
        _covered(F.col(starts), REPEAT).alias("n_repeat_words"),
        left.cast("bigint").alias("left_chars"),
        (F.size(L) - F.size(found)).cast("bigint").alias("n_failed_lines"),
        F.array_join(F.col(found), "\n").alias("cleaned"),
    )
    df = df.withColumn(q, body).drop(w, lines, found, narrow, wide, starts)
    x = F.col(q)
    base_failed = (x["n_words"] < min_words) | (x["n_repeat_words"] > F.lit(max_repeated) * x["n_words"])
    lost = x["word_chars"] - x["left_chars"]
    ok = ~base_failed & (x["n_words"] > 0) & (lost <= F.lit(max_lost) * x["word_chars"])
    fields = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return df.withColumn(
        q,
        F.struct(*[x[f].alias(f) for f in fields], base_failed.alias("base_failed"), lost.alias("lost_chars"), x["n_failed_lines"].alias("n_failed_lines"), ok.alias("kept"), x["cleaned"].alias("cleaned")),
    )


def clean(docs: DataFrame, text: str = "text", **rules) -> DataFrame:
    """Documents that pass, columns unchanged. The text stays whole: the lines decide, and what
    learns from the documents later wants the layout the author gave them."""
    q = base.column_name("q", docs.columns)
    mark = base.column_name("mark", [*docs.columns, q])
    # A filter would be pushed down into the figures and make the lambdas work them out again for
    # each element; it does not pass a column that is not deterministic.
    marked = judged(docs, text, **rules).withColumn(mark, F.monotonically_increasing_id())
    return marked.filter(F.col(q)["kept"] & (F.col(mark) >= 0)).select(*[F.col(f"`{c}`") for c in docs.columns])
