"""Removal of long repeated passages by merged Burrows-Wheeler transforms.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts elsewhere. A transform of the whole corpus would be one unsplittable
object, so the corpus is cut into stretches such that equal strings meet in one task:

1. The anchor of a start is the lowest-hashed 16-gram of the ``SPAN`` positions from it. It depends on the string alone, so equal strings
   have equal anchors at equal distance. Starts with one anchor are a stretch; the bytes that all strings of the anchor have in common
   are its key. A stretch whose key occurs once in the corpus holds no repeated string and goes no further.
2. Equal stretches are one, with a count. Their text is fetched once, and stretches with equal keys meet in a task. Those that share with no
   other one the bytes that all strings of some block of starts have in common go no further (if there are several of one, it repeats as a
   whole). The transforms of shards of the rest are merged by interleave refinement (bwt.py). Intervals of ``LENGTH`` common bytes that hold two
   starts or more are repeats.
3. A key with more than ``MOST`` different stretches (a passage that very many documents share, each with its own surroundings) doesn't
   go to one task. Its starts are counted by themselves: first by blocks of starts with the bytes these have in common, then, in blocks
   that occur more than once, each string by its hash; both counts combine before they are shuffled. It gives the same starts.
4. Repeated starts return to every document that has the stretch.

With ``words`` a string of that many words goes as well if it also starts elsewhere, however few bytes it has and whatever blanks part its
words. That is the same search over codes of words in place of bytes, and both run at once: the keys of words are others.

Hashes of 64 bits stand for the stretches, and of 40 bits or more for 40-byte symbols: a false repeat of 400 bytes takes equal hashes of different
symbols where the nine others agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bwt import STEP, Rolling, mix, repeated
from .common import SPACES, arrow_map, cut, drop, table, text_hash

LENGTH = 400
SPAN = 300
#: Words of a passage, and of the positions among which its anchor is found.
WORDS = 50
WORD_SPAN = 40
MOST = 1000
BYTES_AT_ONCE = UNITS_AT_ONCE = 1 << 18
RUNS = "array<struct<f:int,e:int>>"
SALT = 0x5851F42D4C957F2D

_GAP = np.isin(np.arange(256), list(SPACES.encode()))


def word_places(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word."""
    edge = np.flatnonzero(np.diff(np.r_[True, _GAP[raw], True]))
    return edge[::2], edge[1::2]


@dataclass(frozen=True)
class Unit:
    """What texts are strings of. Lengths and positions are counted in it."""

    dtype: type
    gram: int
    block: int
    step: int

    def read(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Units of all texts, and how many each has."""
        if self.dtype is np.uint8:
            return np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts], np.int64)
        raw = np.frombuffer(b"\n".join(texts), np.uint8)
        first, end = word_places(raw)
        begin = np.cumsum([0, *(len(t) + 1 for t in texts)])
        return Rolling(raw).of(first, end), np.diff(np.searchsorted(first, begin))


BYTE = Unit(np.uint8, 16, 30, STEP)
WORD = Unit(np.uint64, 4, 4, 5)


@dataclass(frozen=True)
class Search:
    """Strings of ``length`` units, with anchors among ``span`` starts. ``salt`` tells its keys from those of another search."""

    unit: Unit
    length: int
    span: int
    salt: int = 0


def stretches(texts: list[bytes], length: int = LENGTH, span: int = SPAN, unit: Unit = BYTE) -> tuple[np.ndarray, ...]:
    """Of each stretch: number of its text, first and last start and anchor (positions in the text), key, and hash of its bytes."""
    raw, size = unit.read(texts)
    none = np.zeros(0, np.int64)
    if not (size >= length).any():
        return none, none, none, none, none, none
    byte0 = np.cumsum(size) - size
    roll = Rolling(raw)
    low = np.uint64((1 << 32) - 1)
    code = roll.plain(unit.gram) & ~low
    code |= low - np.arange(len(code), dtype=np.uint64)  # ties to the right
    rows = -(-len(code) // span) + 1
    padded = np.full(rows * span, np.uint64((1 << 64) - 1))
    padded[: len(code)] = code
    padded = padded.reshape(rows, span)
    down = np.minimum.accumulate(padded[:, ::-1], 1)[:, ::-1].ravel()
    up = np.minimum.accumulate(padded, 1).ravel()
    starts = len(raw) - length + 1
    least = np.minimum(down[:starts], up[span - 1 : span - 1 + starts])
    # a stretch begins with its text or where the anchor changes; starts of strings that no single text has are left out
    own = np.flatnonzero(size >= length)
    begin, last = byte0[own], (byte0 + size)[own] - length
    lo = np.union1d(np.flatnonzero(least[1:] != least[:-1]) + 1, begin)
    among = np.searchsorted(begin, lo, "right") - 1
    inside = (among >= 0) & (lo <= last[among])
    lo, among = lo[inside], among[inside]
    hi = np.minimum(np.r_[lo[1:] - 1, starts - 1], last[among])
    anchor, text = (low - (least[lo] & low)).astype(np.int64), own[among]
    key = roll.of(anchor, anchor + length - span + 1)
    whole = roll.of(lo, hi + length) ^ ((anchor - lo).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    base = byte0[text]
    return text, lo - base, hi - base, anchor - base, key.view(np.int64), whole.view(np.int64)


def _groups(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    begin = 0
    while begin < len(texts):
        end, held = begin, 0
        while end < len(texts) and (end == begin or held + len(texts[end]) <= BYTES_AT_ONCE):
            held += len(texts[end])
            end += 1
        yield begin, end
        begin = end


def find_stretches(docs: DataFrame, searches: list[Search]) -> DataFrame:
    """search (its number), doc_id, th, lo, hi, anchor, key, whole."""
    names = ["search", "doc_id", "th", "lo", "hi", "anchor", "key", "whole"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t.as_py() or "").encode("utf-8", "surrogatepass") for t in batch[2]]
            for a, b in _groups(texts):
                for number, x in enumerate(searches):
                    text, lo, hi, anchor, key, whole = stretches(texts[a:b], x.length, x.span, x.unit)
                    if len(text):
                        at = pa.array(text + a)
                        columns = [batch[0].take(at), batch[1].take(at), *(pa.array(y, pa.int32()) for y in (lo, hi, anchor)), pa.array(key ^ x.salt), pa.array(whole)]
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(text), number, np.int32)), *columns], names)

    return arrow_map(docs, run, "search int, doc_id long, th long, lo int, hi int, anchor int, key long, whole long")


def packed(docs: DataFrame) -> DataFrame:
    """doc_id, th and the compressed text, as it is shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            bodies = [packer.compress((t.as_py() or "").encode("utf-8", "surrogatepass")) for t in batch[2]]
            yield pa.RecordBatch.from_arrays([batch[0], batch[1], pa.array(bodies, pa.binary())], ["doc_id", "th", "body"])

    return arrow_map(docs, run, "doc_id long, th long, body binary")


def fetch(bodies: DataFrame, wanted: DataFrame, searches: list[Search]) -> DataFrame:
    """Bytes (or codes of words) of the wanted stretches (search, doc_id, th, lo, hi, anchor, key, whole, n, hot): search, key, whole, n, hot,
    before (units ahead of the anchor), body."""
    names = ["search", "key", "whole", "n", "hot", "before", "body"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.binary())
        reader = zstandard.ZstdDecompressor()
        for batch in batches:
            for body, list_ in zip(batch[0], batch[1], strict=True):
                text, list_ = reader.decompress(body.as_py()), list_.as_py()
                units = {k: searches[k].unit.read([text])[0] for k in {w["search"] for w in list_}}
                rows = [
                    (w["search"], w["key"], w["whole"], w["n"], w["hot"], w["anchor"] - w["lo"], units[w["search"]][w["lo"] : w["hi"] + searches[w["search"]].length].tobytes())
                    for w in list_
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    lists = wanted.groupBy("doc_id", "th").agg(F.collect_list(F.struct("search", "lo", "hi", "anchor", "key", "whole", "n", "hot")).alias("list"))
    # by sorting at any size, as the lists grow with the documents
    return arrow_map(
        bodies.join(lists.hint("merge"), ["doc_id", "th"]).select("body", "list"), run, "search int, key long, whole long, n long, hot boolean, before int, body binary"
    )


def runs_of(flags: np.ndarray) -> list[dict]:
    """First and last place of each run of true."""
    edge = np.diff(np.r_[0, flags.astype(np.int8), 0])
    return [{"f": int(f), "e": int(e) - 1} for f, e in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)]


def repeated_starts(bodies: list[bytes], counts: list[int], length: int, unit: Unit) -> list[np.ndarray]:
    """Of each stretch which starts hold a string of ``length`` units that all stretches have twice or more."""
    depth = length // unit.step
    s, merged = repeated(bodies, depth, step=unit.step, dtype=unit.dtype)
    size = np.array([len(b) for b in bodies], np.int64) // np.dtype(unit.dtype).itemsize
    own = s.place[merged.node] <= size[s.text[merged.node]] - length
    weight = np.where(own, np.array(counts, np.int64)[s.text[merged.node]], 0)
    often = np.bincount(merged.interval, weight) >= 2
    flags = np.zeros(len(s.rank), bool)
    flags[merged.node] = often[merged.interval] & own
    first = np.cumsum(size + 1) - size - 1
    return [flags[a : a + n - length + 1] for a, n in zip(first.tolist(), size.tolist(), strict=True)]


def shared(keys: list[int], before: list[int], bodies: list[bytes], search: Search) -> np.ndarray:
    """Which stretches can have a string in common with another one: in some block of starts (by their distance to the anchor) the bytes that
    all strings of the block have are those of another stretch with the key. Equal strings have equal distances, so none is lost."""
    unit = search.unit
    size = np.array([len(b) for b in bodies], np.int64) // np.dtype(unit.dtype).itemsize
    end = np.cumsum(size)
    roll = Rolling(np.frombuffer(b"".join(bodies), unit.dtype))
    block = np.arange(-(-search.span // unit.block))
    first = (end - size + np.array(before, np.int64))[:, None] - block * unit.block
    last = first - (unit.block - 1) + search.length
    stretch, which = np.nonzero((first >= (end - size)[:, None]) & (last <= end[:, None]))
    code = roll.of(first[stretch, which], last[stretch, which]) ^ mix(np.array(keys, np.int64).view(np.uint64)[stretch] + which.astype(np.uint64))
    order = np.argsort(code)
    same = code[order[1:]] == code[order[:-1]]
    twice = np.zeros(len(bodies), bool)
    twice[stretch[order[1:][same]]] = twice[stretch[order[:-1][same]]] = True
    return twice


def judge_groups(rows: DataFrame, searches: list[Search]) -> DataFrame:
    """key, whole, runs of the stretches that meet by key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        units = 0
        kind = pa.schema([("key", pa.int64()), ("whole", pa.int64()), ("runs", pa.list_(pa.struct([("f", pa.int32()), ("e", pa.int32())])))])

        def flush() -> pa.RecordBatch:
            search = searches[held[0][0]]
            size = np.dtype(search.unit.dtype).itemsize
            meet = shared([r[1] for r in held], [r[4] for r in held], [r[5] for r in held], search)
            out = [{"key": r[1], "whole": r[2], "runs": [{"f": 0, "e": len(r[5]) // size - search.length}]} for r, m in zip(held, meet, strict=True) if r[3] > 1 and not m]
            if meet.any():
                some = [r for r, m in zip(held, meet, strict=True) if m]
                flags = repeated_starts([r[5] for r in some], [r[3] for r in some], search.length, search.unit)
                out += [{"key": r[1], "whole": r[2], "runs": runs_of(f)} for r, f in zip(some, flags, strict=True) if f.any()]
            return pa.RecordBatch.from_pylist(out, kind)

        for batch in batches:
            for row in zip(*(batch[i].to_pylist() for i in range(6)), strict=True):
                if held and (row[0] != held[-1][0] or units >= UNITS_AT_ONCE and row[1] != held[-1][1]):
                    yield flush()
                    held, units = [], 0
                held.append(row)
                units += len(row[5]) // np.dtype(searches[row[0]].unit.dtype).itemsize
        if held:
            yield flush()

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select("search", "key", "whole", "n", "before", "body").repartition(parts, "key").sortWithinPartitions("search", "key", "whole")
    return arrow_map(dealt, run, f"key long, whole long, runs {RUNS}")


def judge_hot(rows: DataFrame, searches: list[Search]) -> DataFrame:
    """key, whole, runs of stretches whose key has too many for one task.

    Blocks of starts that occur twice as a whole repeat. Of the others, those whose common bytes occur twice are opened, and
    their strings counted one by one.
    """
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "whole", "n", "same", "common", "first", "strings"]
        for batch in batches:
            for search, key, whole, n, before, body in zip(*(batch[i].to_pylist() for i in range(6)), strict=True):
                unit, length, salt = searches[search].unit, searches[search].length, np.uint64(searches[search].salt)
                units = np.frombuffer(body, unit.dtype)
                roll = Rolling(units)
                start = np.arange(len(units) - length + 1)
                string = (roll.of(start, start + length) ^ salt).view(np.int64)
                block = (before - start) // unit.block
                first = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
                last = np.r_[first[1:], len(start)] - 1
                same = (roll.of(first, last + length) ^ salt).view(np.int64)
                # bytes that all strings have which any stretch can have in this block
                a = before - block[first] * unit.block
                b = a - (unit.block - 1) + length
                inside = (a >= 0) & (b <= len(units))
                common = np.where(inside, (roll.of(np.clip(a, 0, len(units)), np.clip(b, 0, len(units))) ^ salt).view(np.int64), 0)
                yield pa.RecordBatch.from_arrays([
                    *(pa.array([v] * len(first), pa.int64()) for v in (key, whole, n)), pa.array(same),
                    pa.array([None if not ok else int(c) ^ int(q) for c, ok, q in zip(common, inside, block[first], strict=True)], pa.int64()),
                    pa.array(first, pa.int32()), pa.array([string[x : y + 1].tolist() for x, y in zip(first, last, strict=True)], pa.list_(pa.int64()))], names)

    found = arrow_map(rows.select("search", "key", "whole", "n", "before", "body"), blocks, "key long, whole long, n long, same long, common long, first int, strings array<long>")
    found = cut(found, "hot-blocks")
    twice = cut(found.groupBy("same").agg(F.sum("n").alias("k")).filter("k > 1").select("same"), "hot-same")
    full = found.join(twice, "same").select("key", "whole", F.struct(F.col("first").alias("f"), (F.col("first") + F.size("strings") - 1).alias("e")).alias("run"))
    # the strings of a block that is not repeated as a whole count themselves and as parts of repeated ones
    more = cut(found.filter("common is not null").groupBy("common").agg(F.sum("n").alias("k")).filter("k > 1").select("common"), "hot-common")
    # a block at the rim of its text lacks some of the common bytes, so its strings are counted in any case
    distinct = found.groupBy("same").agg(*[F.first(c).alias(c) for c in ("key", "whole", "common", "first", "strings")], F.sum("n").alias("n"))
    opened = distinct.join(more, "common").unionByName(distinct.filter("common is null"), allowMissingColumns=True)
    strings = cut(opened.select("key", "whole", "n", "first", F.posexplode("strings").alias("k", "string")).select("key", "whole", "n", (F.col("first") + F.col("k")).alias("at"), "string"), "hot-strings")
    often = cut(strings.groupBy("string").agg(F.sum("n").alias("k")).filter("k > 1").select("string"), "hot-twice")
    lone = strings.filter("n = 1").join(often, "string").select("key", "whole", F.struct(F.col("at").alias("f"), F.col("at").alias("e")).alias("run"))
    return full.unionByName(lone).groupBy("key", "whole").agg(F.collect_set("run").alias("runs"))


def find_repeats(thin: DataFrame, searches: list[Search], most: int) -> DataFrame:
    """search, doc_id, th, lo, runs: repeated starts, from lo, of the documents (doc_id, th, text)."""
    for x in searches:
        if x.length % x.unit.step or x.span > x.length - 2 * x.unit.gram:
            raise ValueError(f"length must be a multiple of {x.unit.step}, and span at least {2 * x.unit.gram} less")
    found = cut(find_stretches(thin, searches), "stretches")
    often = cut(found.groupBy("key").count().filter("count > 1").select("key"), "often")
    live = cut(found.join(often, "key"), "live")
    drop(found, often)
    one = live.groupBy("key", "whole").agg(F.min(F.struct("search", "doc_id", "th", "lo", "hi", "anchor")).alias("x"), F.count("*").alias("n"))
    one = cut(one.select("key", "whole", "x.*", "n"), "one-each")
    kinds = cut(one.groupBy("key").agg(F.count("*").alias("kinds")), "kinds")
    one = cut(one.join(kinds, "key"), "one-of-kinds")
    # a stretch alone with its key repeats as a whole
    simple = one.filter("kinds = 1").select("key", "whole", F.array(F.struct(F.lit(0).alias("f"), (F.col("hi") - F.col("lo")).alias("e"))).alias("runs"))
    fetched = cut(fetch(packed(thin), one.filter("kinds > 1").withColumn("hot", F.col("kinds") > most), searches), "fetched")
    judged = judge_groups(fetched.filter("not hot"), searches).unionByName(simple)
    if one.filter(F.col("kinds") > most).limit(1).count():
        judged = judged.unionByName(judge_hot(fetched.filter("hot"), searches))
    judged = cut(judged, "judged")
    drop(fetched)
    return live.join(judged, ["key", "whole"]).select("search", "doc_id", "th", "lo", "runs")


def with_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", *, length: int = LENGTH, span: int = SPAN, most: int = MOST, words: int | None = None) -> DataFrame:
    """``docs`` with ``_runs``: repeated starts as array of (base, runs), null where there are none. ``length`` is a multiple of 40,
    ``span`` under it by 32 at least. With ``words`` (a multiple of 5, 50 or more) also ``_word_runs``: starts, counted in words, of strings of that many words
    that start elsewhere too, as an array that may be empty. Rows that repeat each other are other places of the same strings. A null key counts as 0. Null and
    empty texts have no strings. Texts of any length are read whole. Further columns stay; names beginning with an underscore are
    reserved. No rows: no rows."""
    thin = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(0)).alias("doc_id"), text_hash(text).alias("th"), F.col(text).alias("text"))
    searches = {"_runs": Search(BYTE, length, span)} | ({"_word_runs": Search(WORD, words, WORD_SPAN, SALT)} if words else {})
    back = find_repeats(thin, list(searches.values()), most)
    own = {name: F.col("search") == number for number, name in enumerate(searches)}
    back = back.groupBy(F.col("doc_id").alias("_doc"), F.col("th").alias("_th")).agg(*[F.collect_set(F.when(c, F.struct("lo", "runs"))).alias(k) for k, c in own.items()])
    at = (F.coalesce(F.col(key).cast("long"), F.lit(0)) == F.col("_doc")) & (text_hash(text) == F.col("_th"))
    return docs.join(back, at, "left").drop("_doc", "_th")


def spans_of(runs: list[dict] | None, length: int) -> list[tuple[int, int]]:
    """Maximal removed spans, first byte and end."""
    return union([(r["lo"] + x["f"], r["lo"] + x["e"] + length) for r in runs or () for x in r["runs"]])


def word_spans(raw: bytes, runs: list[dict] | None, words: int) -> list[tuple[int, int]]:
    """First byte and end of the maximal spans of repeated words. The blank between two strings that only touch stays."""
    if not runs:
        return []
    first, end = word_places(np.frombuffer(raw, np.uint8))
    return union([(int(first[r["lo"] + x["f"]]), int(end[r["lo"] + x["e"] + words - 1])) for r in runs for x in r["runs"]])


def union(*lists: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(x for spans in lists for x in spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def keep(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for a, b in spans:
        parts.append(raw[at:a])
        at = b
    return b"".join([*parts, raw[at:]])


def remove_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", *, length: int = LENGTH, words: int | None = None) -> DataFrame:
    """``docs`` without the repeated bytes, and with ``words`` without repeated strings of that many words; broken characters at the
    cuts go as well. A text that was nothing but repeats becomes empty and stays; null stays null. Columns as before."""
    def bare(t: str | None, runs: list[dict] | None, word_runs: list[dict] | None) -> str | None:
        if not runs and not word_runs:
            return t
        raw = t.encode("utf-8", "surrogatepass")
        return keep(raw, union(spans_of(runs, length), word_spans(raw, word_runs, words))).decode("utf-8", "ignore")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word_runs = batch[n + 1].to_pylist() if words else [None] * batch.num_rows
            texts = [bare(*x) for x in zip(batch[at].to_pylist(), batch[n].to_pylist(), word_runs, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if k == at else batch[k] for k in range(n)], batch.schema.names[:n])

    at, n = docs.columns.index(text), len(docs.columns)
    return arrow_map(with_repeats(docs, key, text, length=length, words=words), run, docs.schema)


def op7_passages(spark, sf_dir: str) -> DataFrame:
    """Bytes, removed bytes and runs, and digest of what is left of every document. Besides, the bytes and runs that go if strings of
    ``WORDS`` words that start elsewhere go as well, which may have fewer than ``LENGTH`` bytes."""
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passage_bytes", "n_passages"]
    kinds = (*[pa.int64()] * 3, pa.string(), pa.int64(), pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t, r, w in zip(batch[1], batch[2].to_pylist(), batch[3].to_pylist(), strict=True):
                raw = (t.as_py() or "").encode("utf-8", "surrogatepass")
                spans = spans_of(r, LENGTH)
                left = keep(raw, spans)
                both = union(spans, word_spans(raw, w, WORDS))
                rows.append((len(raw), len(raw) - len(left), len(spans), hashlib.sha256(left).hexdigest(), sum(b - a for a, b in both), len(both)))
            yield pa.RecordBatch.from_arrays([batch[0], *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True))], names)

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return arrow_map(with_repeats(docs, words=WORDS), run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_passage_bytes long, n_passages long")
