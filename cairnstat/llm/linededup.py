"""Line dedup by a deletion-neighbourhood join, in DataFrame functions only.

Two lines are near if one word inserted, removed or replaced turns one into the other, whatever their length. A line of fewer than
``LEAST_WORDS`` words has an edit bound of 0: one word is too large a part of it, so it is only matched exactly.

1. Equal lines meet by their hash; the earliest (by doc_id, then place) stands for them. What moves is hashes, never text.
2. Only lines that can have a near one go on. A near pair agrees in the first or in the last half of the shorter line, so each distinct
   line gives the hashes of both halves, for its own length and as the longer line of a pair; a line none of whose halves another one
   has is near nothing. That loses no pair. The words of the others are read from their documents.
3. Each of them emits the key of its words and of all variants with one word deleted. Keys that no two lines share go first (an
   aggregation with map-side combining), then the rows of the shared keys are joined back.
4. Lines that share a variant with the deletion at the same place differ in that word; a line that equals a variant of another one
   lacks one word. Each row is paired with the earliest of those it meets, never with all of them, so that a group of any size gives at
   most two pairs a row. The edit distance of each pair is verified on its words.
5. A line is dropped if an earlier line is equal or near.

A group of any size only meets aggregations with partial results, and joins that Spark can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, cut, drop, let, row_id, table, text_hash
from .quality import has_word, words_of

LEAST_WORDS = 6
#: Stands for the hash of a word before and after a line's words.
RIM = 0
AT = ["doc_id", "th", "line"]
HALVES = ["p0", "s0", "p1", "s1"]


def halves(line: Column) -> Column:
    """Hashes of the first and last half of a line's words, for pairs whose shorter line has its number of words (p0, s0) and one less
    (p1, s1). Null where no such pair is near."""
    def of(words: Column) -> Column:
        n = F.size(words)

        def half(least: int, side: int) -> Column:
            shorter = n - least
            front = F.floor(shorter / 2).cast("int")
            part = F.slice(words, F.lit(1), front) if side == 0 else F.slice(words, n - (shorter - front) + 1, shorter - front)
            return F.when(shorter >= LEAST_WORDS, F.xxhash64(shorter, F.lit(side), part))

        return F.struct(*[half(least, side).alias(name) for name, (least, side) in zip(HALVES, [(0, 0), (0, 1), (1, 0), (1, 1)], strict=True)])

    return let(words_of(line), of)


def occurrences(docs: DataFrame, key: str, text: str) -> DataFrame:
    """A row per line with a word: doc_id, th (hash of the text), line (from 0), its text and its two hashes."""
    lines = docs.select(row_id(key).alias("doc_id"), text_hash(text).alias("th"), F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("line", "body"))
    return lines.filter(has_word(F.col("body"))).withColumns({"h": F.xxhash64("body"), "h2": F.hash("body")})


def _distance_at_most_one(a: Column, b: Column) -> Column:
    """Edit distance of two arrays is 0 or 1."""
    same = let(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), lambda z: F.size(F.filter(z, lambda x: ~x)) <= 1)

    def lacks_one(short: Column, long: Column) -> Column:
        ahead = F.coalesce(F.array_position(F.zip_with(short, F.slice(long, F.lit(1), F.size(short)), lambda x, y: x == y), False), F.lit(0))
        at = F.when(ahead == 0, F.size(long)).otherwise(ahead).cast("int")
        return F.concat(F.slice(long, F.lit(1), at - 1), F.slice(long, at + 1, F.size(long))) == short

    return F.when(F.size(a) == F.size(b), same).when(F.size(b) - F.size(a) == 1, lacks_one(a, b)).when(F.size(a) - F.size(b) == 1, lacks_one(b, a)).otherwise(False)


def distinct_lines(found: DataFrame) -> DataFrame:
    """The first occurrence of each line with the hashes of its halves, and ``n``, how often it stands."""
    hashed = found.withColumn("halves", halves(F.col("body"))).select("h", "h2", *AT, "halves.*")
    first = hashed.groupBy("h", "h2").agg(F.min(F.struct(*AT)).alias("at"), F.count("*").alias("n"), *[F.first(c).alias(c) for c in HALVES])
    return first.select("h", "h2", "at.*", "n", *HALVES)


def words_of_lines(docs: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """h, h2, doc_id, th, line and ``words`` of the wanted lines (h, h2, doc_id, th, line). Each document's text moves once, however often
    its row repeats."""
    lists = wanted.groupBy("doc_id", "th").agg(F.collect_list(F.struct("line", "h", "h2")).alias("list"))
    texts = docs.select(row_id(key).alias("doc_id"), text_hash(text).alias("th"), F.col(text).alias("text")).dropDuplicates(["doc_id", "th"])
    picked = let(F.split("text", "\n"), lambda ls: F.transform("list", lambda x: F.struct(x["line"].alias("line"), x["h"].alias("h"), x["h2"].alias("h2"), F.get(ls, x["line"]).alias("body"))))
    # by sorting at any size, as the lists grow with the documents
    each = texts.join(lists.hint("merge"), ["doc_id", "th"]).select("doc_id", "th", F.inline(picked))
    return each.select("h", "h2", *AT, words_of(F.col("body")).alias("words"))


def variants(lines: DataFrame) -> DataFrame:
    """key, gap, doc_id, th, line of lines with their words: gap 0 is the whole line, else the place of the deleted word.

    A sequence's key is its length and two sums: of the hashes of neighbouring words, and of words with one between them, the rims of
    the line taking part. Deleting a word changes three and five terms, so a variant takes a few steps however long its line is.
    """
    n = F.size("u")

    def at(i: Column) -> Column:
        return F.coalesce(F.get("u", i), F.lit(RIM).cast("long"))

    def near(i: Column, j: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(F.lit(1), at(i), at(j)), 24)

    def apart(i: Column, j: Column) -> Column:
        return F.when((i >= -1) & (j <= n), F.shiftrightunsigned(F.xxhash64(F.lit(2), at(i), at(j)), 24)).otherwise(F.lit(0).cast("long"))

    zero = F.lit(0).cast("long")
    places = F.sequence(F.lit(0), n)
    whole = lines.select(*AT, F.transform("words", lambda w: F.xxhash64(w)).alias("u")).select(
        *AT, "u",
        F.aggregate(places, zero, lambda held, j: held + near(j - 1, j)).alias("g"), F.aggregate(places, zero, lambda held, j: held + apart(j - 2, j)).alias("s"))
    rows = whole.select("*", F.explode(places).alias("gap"))
    i = F.col("gap") - 1
    g = F.col("g") - near(i - 1, i) - near(i, i + 1) + near(i - 1, i + 1)
    s = F.col("s") - apart(i - 2, i) - apart(i - 1, i + 1) - apart(i, i + 2) + apart(i - 2, i + 1) + apart(i - 1, i + 2)
    key = F.when(F.col("gap") == 0, F.xxhash64(n, "g", "s")).otherwise(F.xxhash64(n - 1, g, s))
    return rows.select("gap", key.alias("key"), *AT)


def near_lines(lines: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """h, h2, doc_id, th and line of the distinct lines that have an earlier near line. ``lines`` is read several times."""
    at = F.struct(*AT)
    sides = lines.select("h", F.explode(F.array_compact(F.array(*HALVES))).alias("half"))
    # written first here and below, so that Spark can split a key with very many lines in the join; joined by sorting at any size
    twice = cut(sides.groupBy("half").count().filter("count > 1").select("half"), "shared-halves")
    hashes = cut(sides.join(twice.hint("merge"), "half").select("h").distinct(), "live-hashes")
    live = lines.select("h", "h2", *AT).join(hashes.hint("merge"), "h", "left_semi")
    units = cut(words_of_lines(docs, live, key, text), "line-words")
    every = variants(units)
    # a line with one word several times in a row meets itself in as many variants
    two = F.xxhash64(*AT)
    shared = cut(every.groupBy("key").agg(F.min(two).alias("a"), F.max(two).alias("z")).filter("a != z").select("key"), "shared-keys")
    rows = cut(every.join(shared.hint("merge"), "key").select("key", "gap", at.alias("at")), "line-keys")
    drop(twice, hashes, shared)
    first = rows.groupBy("key", "gap").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    first = cut(first, "first-lines")
    # of each key: the earliest line that is the key, and the earliest that is it with one word more
    tops = first.groupBy("key").agg(F.min(F.when(F.col("gap") == 0, F.col("first"))).alias("whole"), F.min(F.when(F.col("gap") > 0, F.col("first"))).alias("more"))
    met = first.join(tops, "key").withColumn("other", F.when(F.col("gap") == 0, F.col("more")).otherwise(F.col("whole")))
    met = cut(met.filter("first != last OR other < last").select("key", "gap", "first", "other"), "met-lines")
    pairs = rows.join(met.hint("merge"), ["key", "gap"]).select(F.col("at").alias("late"), F.explode(F.array_compact(F.array("first", "other"))).alias("early")).filter("early < late").distinct()
    words = units.select(at.alias("at"), "words", "h", "h2")
    with_late = pairs.join(words.select(F.col("at").alias("late"), F.col("words").alias("w1"), "h", "h2"), "late")
    with_both = with_late.join(words.select(F.col("at").alias("early"), F.col("words").alias("w2")), "early")
    found = cut(with_both.filter(_distance_at_most_one(F.col("w1"), F.col("w2"))).select("h", "h2", "late.*").distinct(), "near-lines")
    drop(rows, first, met, units)
    return found


def dropped_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, th (hash of the text), line and ``exact`` of every line that has an earlier equal (exact) or near (not exact) line.

    Lines without a word stay. A null doc_id comes first, as the lowest number. Rows with one doc_id and different texts are
    documents of their own, in the order of the texts' hashes; rows that repeat both are one document with one verdict. Null,
    empty texts and empty tables have no lines to drop. Further columns are not read.
    """
    found = occurrences(docs, key, text)
    lines = cut(distinct_lines(found), "lines")
    near = near_lines(lines, docs, key, text).select("h", "h2", *AT, F.lit(True).alias("near"))
    # of lines that stand once and have no near one nothing needs to be known
    often = lines.filter("n > 1").select("h", "h2", *AT, F.lit(False).alias("near"))
    verdict = often.unionByName(near).groupBy("h", "h2").agg(F.first(F.struct(*AT)).alias("first"), F.max("near").alias("near"))
    verdict = cut(verdict, "line-verdicts")
    judged = found.drop("body").join(verdict.hint("merge"), ["h", "h2"])
    exact = F.col("first") != F.struct(*AT)
    return judged.filter(exact | F.col("near")).select(*AT, exact.alias("exact"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without dropped lines. A document that had lines with words and lost all of them goes; others stay as they are,
    with all their columns. Names beginning with an underscore are reserved. No rows: no rows."""
    gone = dropped_lines(docs, key, text).groupBy("doc_id", "th").agg(F.collect_set("line").alias("_gone")).withColumnsRenamed({"doc_id": "_doc", "th": "_th"})
    own = (F.col("_id") == F.col("_doc")) & (F.col("_own") == F.col("_th"))
    joined = docs.withColumns({"_id": row_id(key), "_own": text_hash(text)}).join(gone, own, "left")
    kept = let(F.split(F.col(text), "\n"), lambda ls: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), "_gone"), lambda i: F.get(ls, i)), "\n"))
    cleaned = joined.withColumn(text, F.when(F.col("_gone").isNull(), F.col(text)).otherwise(kept))
    return cleaned.filter(F.col("_gone").isNull() | (F.length(F.translate(F.col(text), SPACES, "")) > 0)).select(*docs.columns)


def op10_lines(spark, sf_dir: str) -> DataFrame:
    """Per document: lines with a word, dropped ones by reason, and the numbers of the dropped lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = docs.select("doc_id", row_id("doc_id").alias("id"), text_hash("text").alias("th"), F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), has_word)).cast("long").alias("n_lines"))
    gone = dropped_lines(docs).groupBy(F.col("doc_id").alias("id"), "th").agg(
        F.count_if("exact").alias("n_exact"), F.count_if(~F.col("exact")).alias("n_near"), F.sort_array(F.collect_set("line")).alias("lines"))
    none = F.lit(0).cast("long")
    return counted.join(gone, ["id", "th"], "left").select(
        "doc_id", "n_lines", F.coalesce("n_exact", none).alias("n_exact"), F.coalesce("n_near", none).alias("n_near"),
        F.coalesce(F.array_join(F.transform("lines", lambda x: x.cast("string")), ","), F.lit("")).alias("dropped"))


_WORDS = "list_filter(regexp_split_to_array({0}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"
#: By the rule alone: pairs that agree in half of the shorter line, compared word by word.
OP10_SQL = f"""
WITH o AS (SELECT doc_id, i - 1 AS line, ls[i] AS body FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
w AS (SELECT *, {_WORDS.format('body')} AS ws FROM o),
l AS (SELECT * FROM w WHERE len(ws) > 0),
d AS (SELECT body, min((doc_id, line)) AS pos, any_value(ws) AS ws FROM l GROUP BY body),
u AS (SELECT pos, ws, len(ws) AS n FROM d WHERE len(ws) >= {LEAST_WORDS}),
c AS (SELECT pos, ws, n, unnest([n, n - 1]) AS c FROM u),
k AS (SELECT pos, ws, n, c, 0 AS side, ws[1:c // 2] AS half FROM c WHERE c >= {LEAST_WORDS}
 UNION ALL SELECT pos, ws, n, c, 1 AS side, ws[n - (c - c // 2) + 1:n] AS half FROM c WHERE c >= {LEAST_WORDS}),
p AS (SELECT a.pos AS pos, CASE WHEN a.n <= b.n THEN a.ws ELSE b.ws END AS s, CASE WHEN a.n <= b.n THEN b.ws ELSE a.ws END AS t
 FROM k a JOIN k b ON a.c = b.c AND a.side = b.side AND a.half = b.half AND b.pos < a.pos),
q AS (SELECT pos, s, t, coalesce(list_position(list_transform(range(1, len(s) + 1), lambda i: s[i] <> t[i]), true), len(s) + 1) AS x FROM p),
n AS (SELECT DISTINCT pos FROM q WHERE CASE WHEN len(s) = len(t) THEN s[x + 1:] = t[x + 1:] ELSE len(t) = len(s) + 1 AND s[x:] = t[x + 1:] END),
j AS (SELECT l.doc_id, l.line, d.pos <> (l.doc_id, l.line) AS exact, n.pos IS NOT NULL AS near FROM l JOIN d USING (body) LEFT JOIN n ON n.pos = d.pos),
g AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (exact) AS n_exact, count(*) FILTER (near AND NOT exact) AS n_near,
 coalesce(string_agg(line::VARCHAR, ',' ORDER BY line) FILTER (exact OR near), '') AS dropped FROM j GROUP BY doc_id)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_exact, 0)::BIGINT AS n_exact, coalesce(n_near, 0)::BIGINT AS n_near, coalesce(dropped, '') AS dropped
FROM documents LEFT JOIN g USING (doc_id)
"""
