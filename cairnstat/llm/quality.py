"""Line-first cleaning, in SQL functions only.

Each line of a text is judged by itself: a line fails if it has no word, if it looks like navigation (separators,
menu words, breadcrumb arrows), if it is boilerplate (notices about cookies, rights, scripts ...), if it is mostly
symbols, or if it is a short fragment without end punctuation. Failing lines go; a document of which too large a share of
characters went is rejected.

Every figure is computed inside its row with array functions: no shuffle, and no row meets another one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, WORD_BREAK, let, table

SYMBOLS = "#*$%&|<>"
#: Boilerplate wording (lower case); a line with one of these goes, however long it is.
BOILERPLATE = (
    "all rights reserved", "copyright (c)", "©", "cookie policy", "cookie settings", "cookie notice", "cookies policy", "cookies settings",
    "cookies notice", "we use cookies", "accept cookies", "accept all cookies", "privacy policy", "terms of use", "terms of service",
    "terms and conditions", "enable javascript", "javascript is disabled", "javascript is required", "subscribe to our newsletter",
    "click here", "read more", "share this", "share on", "powered by", "lorem ipsum", "back to top", "skip to content", "skip to main content",
)
MENU = "(?:home|menu|log ?in|sign ?(?:in|up|out)|register|contact(?: us)?|about(?: us)?|faq|sitemap|search|next|previous|help|privacy|terms|blog|news|shop|cart)"
END_PUNCTUATION = "[.!?…:;\"'”»’)\\]。！？؟।]$"
MIN_WORDS = 20
REPEAT_PERCENT = 30
WINDOW = 8
MAX_LOST = 0.6
SHORT_LINE_WORDS = 4
#: A line of more than SHORT_LINE_WORDS words, however long they are.
MORE_WORDS = f"^[\\x20\\x09-\\x0D]*+(?:[^\\x20\\x09-\\x0D]++[\\x20\\x09-\\x0D]++){{{SHORT_LINE_WORDS}}}[^\\x20\\x09-\\x0D]"


def words_of(text: Column) -> Column:
    """Words of a text. Where blanks are the only white space, splitting takes no pattern matching."""
    parts = F.when(text.rlike("[\\x09-\\x0D]"), F.split(text, WORD_BREAK)).otherwise(F.split(text, " "))
    return F.array_remove(parts, "")


def has_word(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACES)) != ""


def repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows that occur twice or more in ``words``, the first occurrence included."""
    def starts(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(pairs, lambda p: F.sort_array(F.filter(
            F.transform(p, lambda e, j: F.when(
                (F.get(p, j - 1)["h"] == e["h"]) | (F.get(p, j + 1)["h"] == e["h"]), e["i"])),
            lambda i: i.isNotNull())))

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda s, j: F.least(F.lit(window), F.coalesce(F.get(at, j + 1) - s, F.lit(window))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, b: a + b)

    def count(ws: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(1), F.size(ws) - (window - 1)), lambda i: F.xxhash64(F.slice(ws, i, window)))
        return let(hashes, lambda hs: F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0).cast("long"))
                   .otherwise(let(starts(hs), covered)))

    return let(words, lambda ws: F.when(F.size(ws) <= window, F.lit(0).cast("long")).otherwise(count(ws)))


def boilerplate(low: Column) -> Column:
    """Whether a lower-cased text has boilerplate wording."""
    found = F.lit(False)
    for words in BOILERPLATE:
        found = found | F.contains(low, F.lit(words))
    return found


def line_fails(line: Column, suspect: Column) -> Column:
    """True for a line that goes; it must have been bound by a lambda or be a column. ``suspect``: the text of the line may have
    boilerplate wording; where the whole text has none, no line of it does."""
    chars = F.length(F.translate(line, SPACES, ""))
    symbols = F.length(line) - F.length(F.translate(line, SYMBOLS, ""))
    separators = F.length(line) - F.length(F.translate(line, "|›»>•·", ""))
    return (
        (chars == 0)
        | (symbols * 5 > chars)
        | ((separators >= 2) & (separators * 12 >= F.length(line)))
        | (~line.rlike(MORE_WORDS) & (~F.rtrim(line).rlike(END_PUNCTUATION) | F.lower(line).rlike(f"^\\W*{MENU}(?:\\W+{MENU})*\\W*$")))
        | (suspect & let(F.lower(line), boilerplate))
    )


def clean_lines(text: Column) -> Column:
    """Lines of ``text`` that pass all rules, in their order."""
    suspect = let(F.lower(text), boilerplate)
    return let(suspect, lambda s: F.filter(F.split(text, "\n"), lambda line: ~line_fails(line, s)))


def quality_columns(df: DataFrame, text: str = "text", *, max_lost: float = MAX_LOST) -> DataFrame:
    """``df`` with the base counts, ``base_failed``, ``lost`` (share of word characters in failing lines), ``kept``.

    Null and empty texts have no word: base_failed, not kept, lost 0. Further columns of ``df`` stay; columns of
    the names added here are replaced; names beginning with an underscore are reserved. A row's verdict depends on its text alone, so
    repeated rows get equal ones. No rows: no rows.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    bare = F.length(F.translate(t, SPACES, "")).cast("long")
    dup = let(F.filter(F.split(t, "\n"), has_word), lambda ls: F.size(ls) - F.size(F.array_distinct(ls))).cast("long")
    counts = let(words_of(t), lambda ws: F.struct(F.size(ws).cast("long").alias("n"), repeat_words(ws).alias("r")))
    left = F.aggregate(clean_lines(t), F.lit(0).cast("long"), lambda a, line: a + F.length(F.translate(line, SPACES, "")))
    out = df.withColumn("_counts", counts).withColumns({
        "n_words": F.col("_counts.n"),
        "word_chars": bare,
        "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": dup,
        "n_repeat_words": F.col("_counts.r"),
        "_left": left,
    }).drop("_counts")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    lost = F.when(F.col("word_chars") > 0, 1 - F.col("_left") / F.col("word_chars")).otherwise(F.lit(0.0))
    return out.withColumns({"base_failed": failed, "lost": lost}).withColumn(
        "kept", ~F.col("base_failed") & (F.col("lost") <= max_lost)).drop("_left")


def clean_documents(df: DataFrame, text: str = "text", *, max_lost: float = MAX_LOST) -> DataFrame:
    """The kept documents with their failing lines removed."""
    judged = quality_columns(df, text, max_lost=max_lost).filter("kept")
    return judged.withColumn(text, F.array_join(clean_lines(F.col(text)), "\n")).select(*df.columns)


def op2_quality(spark, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_columns(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("lost", 6).alias("lost"))


def _sql_line_fails(line: str) -> str:
    squeeze = f"translate({line}, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13), '')"
    n_words = f"len(list_filter(regexp_split_to_array({line}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> ''))"
    sep = f"(length({line}) - length(translate({line}, '|›»>•·', '')))"
    menu = MENU.replace("'", "''")
    boiler = " OR ".join(f"contains(lower({line}), '{w}')" for w in BOILERPLATE)
    end = END_PUNCTUATION.replace("'", "''")
    return (
        f"(length({squeeze}) = 0 OR (length({line}) - length(translate({line}, '{SYMBOLS}', ''))) * 5 > length({squeeze})"
        f" OR ({sep} >= 2 AND {sep} * 12 >= length({line}))"
        f" OR ({n_words} <= {SHORT_LINE_WORDS} AND regexp_matches(lower({line}), '^\\W*{menu}(?:\\W+{menu})*\\W*$'))"
        f" OR ({boiler})"
        f" OR ({n_words} <= {SHORT_LINE_WORDS} AND NOT regexp_matches(rtrim({line}), '{end}')))"
    )


OP2_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws FROM d),
grams AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM grams) WHERE c > 1),
cov AS (SELECT doc_id, sum(least(8, coalesce(nxt - i, 8)))::BIGINT AS r FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM rep) GROUP BY doc_id),
ln AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
lj AS (SELECT doc_id, line, length(translate(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13), '')) AS c, {_sql_line_fails('line')} AS bad FROM ln),
ls AS (SELECT doc_id, (count(*) FILTER (c > 0) - count(DISTINCT line) FILTER (c > 0))::BIGINT AS dup, coalesce(sum(c) FILTER (NOT bad), 0)::BIGINT AS lft, sum(c)::BIGINT AS wc FROM lj GROUP BY doc_id),
b AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, wc AS word_chars, (length(t) - length(translate(t, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
 dup AS n_dup_lines, coalesce(r, 0)::BIGINT AS n_repeat_words, CASE WHEN wc > 0 THEN 1 - lft / wc ELSE 0.0 END AS lost
 FROM w JOIN ls USING (doc_id) LEFT JOIN cov USING (doc_id)),
f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, (NOT base_failed AND lost <= {MAX_LOST}) AS kept, round(lost, 6)::DOUBLE AS lost FROM f
"""
