"""Language identification: script ranges narrow the candidates, then Viterbi over per-word scores labels spans.

Model. For each language the relative frequencies of hashed letter n-grams (lengths 1 to 4, with word ends) in a
bounded sample of labelled texts: about ``per_lang`` texts of each language, drawn by a hash of the key. Counting runs on
the executors; what reaches the driver has ``BUCKETS`` rows at most. A word's score for a language is the
log likelihood of its n-grams; languages that use the script of a word in less than ``SCRIPT_SHARE`` of their training
words are not candidates for it.

Labelling. Words of a text are the observations, languages the states, and each switch of language costs ``penalty``.
The best path is exact: blocks of ``BLOCK`` words are solved side by side from every start state, then joined in order, and
solved once more from the one start state that the best path has, which takes one back pointer a word and state. So long texts cost
no more steps than short ones. Neighbouring words with equal labels form the spans.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, table

BUCKETS = 1 << 16
LENGTHS = (1, 2, 3, 4)
BLOCK = 64
PENALTY = 12.0
PER_LANG = 1500
SCRIPT_SHARE = 0.01
CHARS_AT_ONCE = 500_000
WORDS_AT_ONCE = 40_000

#: First and last code points of scripts, from the Unicode block list.
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x250, 0x2AF), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF)],
}
SCRIPT_NAMES = ["other", *SCRIPTS]


@functools.lru_cache(1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Of every code point: whether it is a letter, and its script's number."""
    letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    script = np.zeros(0x110000, np.int8)
    for k, ranges in enumerate(SCRIPTS.values(), 1):
        for a, b in ranges:
            script[a : b + 1] = k
    return letter, script


@dataclass
class Words:
    """Words (runs of letters) of several texts laid end to end."""

    codes: np.ndarray  # code points of all texts, lower case, a blank after each text
    first: np.ndarray  # place of each word's first letter
    end: np.ndarray
    doc: np.ndarray  # number of the text that the word is in
    script: np.ndarray  # of the first letter


def split_words(texts: list[str]) -> Words:
    letter, script = _letters()
    lower = [t.lower() for t in texts]
    codes = np.frombuffer((" ".join(lower) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = np.zeros(len(codes) + 2, np.int8)
    is_letter[1:-1] = letter[codes]
    step = np.diff(is_letter)
    first, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    stops = np.cumsum([len(t) + 1 for t in lower])
    return Words(codes, first, end, np.searchsorted(stops, first, "right"), script[codes[first]])


def word_slices(words: Words, n: int) -> Iterator[Words]:
    """The same words, about ``n`` at a time."""
    n = max(n, 1000)
    for k in range(0, len(words.first), n):
        yield Words(words.codes, *(x[k : k + n] for x in (words.first, words.end, words.doc, words.script)))


def letter_slices(lower: str) -> Iterator[tuple[int, str]]:
    """Place and text of slices of about CHARS_AT_ONCE that cut no word; a word longer than that is a slice of its own."""
    begin = 0
    while begin < len(lower):
        end = min(begin + CHARS_AT_ONCE, len(lower))
        while end < len(lower) and lower[end].isalpha():
            end += 1
        yield begin, lower[begin:end]
        begin = end


def ngrams(words: Words) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Where each word begins among the letters of all words, read with a mark at both ends; and for each length
    the bucket of the n-gram at each letter, and whether it ends within its word."""
    n = words.end - words.first + 2
    starts = np.concatenate([[0], np.cumsum(n)])
    total = int(starts[-1])
    at = np.arange(total) - np.repeat(starts[:-1] - words.first + 1, n)
    chars = words.codes[np.clip(at, 0, len(words.codes) - 1)].astype(np.uint64)
    chars[starts[:-1]] = 1
    chars[starts[1:] - 1] = 2
    room = np.repeat(starts[1:], n) - np.arange(total)
    found = []
    rolled = np.zeros(total, np.uint64)
    for k in LENGTHS:
        rolled[: total - k + 1] = rolled[: total - k + 1] * np.uint64(0x9E3779B97F4A7C15) + chars[k - 1 :] + np.uint64(k)
        mixed = ((rolled ^ (rolled >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(48)
        found.append((mixed.astype(np.int64) % BUCKETS, room >= k))
    return starts, found


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # BUCKETS x languages, log likelihood less the mean over languages
    uses: np.ndarray  # scripts x languages: the language is a candidate for words of the script

    def score(self, words: Words) -> np.ndarray:
        """Words x languages."""
        if not len(words.first):
            return np.zeros((0, len(self.langs)), np.float32)
        return np.concatenate([self._score(part) for part in word_slices(words, 8 * WORDS_AT_ONCE // max(8, len(self.langs)))])

    def _score(self, words: Words) -> np.ndarray:
        starts, found = ngrams(words)
        each = np.zeros((int(starts[-1]), len(self.langs)), np.float32)
        for buckets, fits in found:
            got = self.weights[buckets]
            got[~fits] = 0
            each += got
        out = np.add.reduceat(each, starts[:-1], axis=0)
        out[~self.uses[words.script]] = -1e6
        return out


def viterbi(scores: np.ndarray, doc: np.ndarray, n_docs: int, penalty: float) -> np.ndarray:
    """Best state of each word; ``doc`` ascends. Exact, ties to the lower state, then to staying."""
    total, k = scores.shape
    if not total:
        return np.zeros(0, np.int64)
    lens = np.bincount(doc, minlength=n_docs)
    firsts = np.concatenate([[0], np.cumsum(lens)[:-1]])
    blocks = -(-lens // BLOCK)
    owner = np.repeat(np.arange(n_docs), blocks)
    in_doc = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    at = firsts[owner] + in_doc * BLOCK
    size = np.minimum(BLOCK, lens[owner] - in_doc * BLOCK)
    order = np.argsort(-size, kind="stable")
    at_o, size_o = at[order], size[order]
    nb = len(order)
    steps = int(size_o[0])
    live_at = [int(np.searchsorted(-size_o, -t, "left")) for t in range(steps)]  # blocks with a word t
    value = np.full((nb, k, k), -np.inf, np.float64)  # block, state of the first word, state now
    value[:, np.arange(k), np.arange(k)] = scores[at_o]
    for t in range(1, steps):
        v = value[: live_at[t]]
        value[: live_at[t]] = np.maximum(v, v.max(2, keepdims=True) - penalty) + scores[at_o[: live_at[t]] + t][:, None, :]
    place = np.empty(nb, np.int64)
    place[order] = np.arange(nb)
    block0 = np.cumsum(blocks) - blocks
    docs = np.argsort(-blocks, kind="stable")
    docs = docs[blocks[docs] > 0]
    entry = np.zeros((nb, k), np.int16)  # by end state: state of the block's first word
    came = np.zeros((nb, k), np.int16)  # by end state: end state of the block before
    sofar = np.zeros((n_docs, k))
    for b in range(int(blocks.max())):
        live = docs[: int(np.searchsorted(-blocks[docs], -b, "left"))]
        m = value[place[block0[live] + b]]
        if b:
            prev = sofar[live]
            top = prev.argmax(1)
            best = prev[np.arange(len(live)), top] - penalty
            stay = prev >= best[:, None]
            start = np.where(stay, prev, best[:, None])
            source = np.where(stay, np.arange(k), top[:, None])
            m = m + start[:, :, None]
        first = m.argmax(1)
        sofar[live] = np.take_along_axis(m, first[:, None, :], 1)[:, 0]
        entry[block0[live] + b] = first
        if b:
            came[block0[live] + b] = np.take_along_axis(source, first, 1)
    last = sofar.argmax(1)
    end_state, start_state = np.zeros(nb, np.int64), np.zeros(nb, np.int64)
    for b in range(int(blocks.max()) - 1, -1, -1):
        live = docs[: int(np.searchsorted(-blocks[docs], -b, "left"))]
        ids = block0[live] + b
        end_state[ids] = last[live]
        start_state[ids] = entry[ids, last[live]]
        last[live] = came[ids, last[live]]
    out = np.empty(total, np.int64)
    state, begin = end_state[order], start_state[order]
    back = np.zeros((steps, nb, k), np.int16)
    own = np.full((nb, k), -np.inf)
    own[np.arange(nb), begin] = scores[at_o, begin]
    for t in range(1, steps):
        n = live_at[t]
        v = own[:n]
        top = v.argmax(1)
        best = v[np.arange(n), top][:, None] - penalty
        stay = v >= best
        back[t, :n] = np.where(stay, np.arange(k), top[:, None])
        own[:n] = np.where(stay, v, best) + scores[at_o[:n] + t]
    for t in range(steps - 1, -1, -1):
        n = live_at[t]
        out[at_o[:n] + t] = state[:n]
        if t:
            state[:n] = back[t, np.arange(n), state[:n]]
    return out


def read_words(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each word: first and end place in its lower-cased text, number of the text, scores. Long texts are read slice by slice."""
    if len(texts) > 1:
        words = split_words(texts)
        base = np.concatenate([[0], np.cumsum([len(t.lower()) + 1 for t in texts])])[words.doc]
        return words.first - base, words.end - base, words.doc, model.score(words)
    found = [(at, split_words([part])) for at, part in letter_slices(texts[0].lower())]
    first = np.concatenate([at + w.first for at, w in found] or [np.zeros(0, np.int64)])
    end = np.concatenate([at + w.end for at, w in found] or [np.zeros(0, np.int64)])
    scores = np.concatenate([model.score(w) for _, w in found] or [np.zeros((0, len(model.langs)), np.float32)])
    return first, end, np.zeros(len(first), np.int64), scores


def label_texts(model: Model, texts: list[str | None], penalty: float, spans: bool = False) -> list[tuple]:
    """(language, score, spans) of each text; ``und`` and 0 without a letter."""
    out: list[tuple] = []
    begin = 0
    while begin < len(texts):
        end, chars = begin, 0
        while end < len(texts) and (end == begin or chars + len(texts[end] or "") <= CHARS_AT_ONCE):
            chars += len(texts[end] or "")
            end += 1
        part = [t or "" for t in texts[begin:end]]
        first, stop, doc, scores = read_words(model, part)
        best = viterbi(scores, doc, len(part), penalty)
        letters = stop - first
        mass = np.zeros((len(part), len(model.langs)))
        np.add.at(mass, (doc, best), letters)
        total, top = mass.sum(1), mass.argmax(1)
        share = mass[np.arange(len(part)), top] / np.maximum(total, 1)
        runs: list[list] = [[] for _ in part]
        if spans and len(best):
            cutoff = np.flatnonzero(np.r_[True, (np.diff(best) != 0) | (np.diff(doc) != 0)])
            for a, b in zip(cutoff, np.r_[cutoff[1:], len(best)], strict=True):
                runs[doc[a]].append((int(first[a]), int(stop[b - 1]), model.langs[best[a]]))
        out += [(model.langs[top[i]], float(share[i]), runs[i]) if total[i] else ("und", 0.0, []) for i in range(len(part))]
        begin = end
    return out


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def draw_limit(wanted: int, there: int) -> int:
    """The 64-bit number up to which a hash draws ``wanted`` of ``there`` rows."""
    return min(1 << 64, (wanted << 64) // max(there, 1)) - (1 << 63) - 1


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", *, per_lang: int = PER_LANG) -> Model:
    """Learn from a sample of the rows of ``docs`` that have both text and language: about ``per_lang`` of each language, all of them
    where there are no more.

    No such rows, or no letter in any: a model without languages, which calls every text ``und``.
    """
    labelled = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(key).alias("key")).filter("text IS NOT NULL AND lang IS NOT NULL")
    n = {r[0]: r[1] for r in labelled.groupBy("lang").count().collect()}  # a row per language
    langs = sorted(n)
    if not langs:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((len(SCRIPT_NAMES), 0), bool))
    # the hash takes any 64-bit number, so a share however small still draws
    limit = F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(draw_limit(per_lang, n[k])))])
    sample = labelled.filter(F.xxhash64(F.coalesce(F.col("key").cast("string"), F.col("text")), F.lit("fit")) <= limit[F.col("lang")]).select("lang", "text")
    drawn = BUCKETS + len(SCRIPT_NAMES)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, text in zip(batch["lang"].to_pylist(), batch["text"], strict=True):
                own = sums.setdefault(name, np.zeros(drawn + 1, np.int64))
                own[drawn] += 1
                for _, part in letter_slices(text.as_py().lower()):
                    for words in word_slices(split_words([part]), WORDS_AT_ONCE):
                        for buckets, fits in ngrams(words)[1]:
                            own[:BUCKETS] += np.bincount(buckets[fits], minlength=BUCKETS)
                        own[BUCKETS:drawn] += np.bincount(words.script, minlength=len(SCRIPT_NAMES))
        for name, own in sums.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at, pa.int32()), pa.array(own[at])], ["lang", "b", "c"])

    rows = arrow_map(sample, count, "lang string, b int, c long").groupBy("lang", "b").agg(F.sum("c").alias("c")).toArrow()
    table_ = np.zeros((drawn + 1, len(langs)))
    table_[rows["b"].to_numpy(), np.searchsorted(langs, rows["lang"].to_pylist())] = rows["c"].to_numpy()
    if missing := [k for k, x in zip(langs, table_[drawn], strict=True) if not x]:
        raise RuntimeError(f"no text was drawn of {missing}")
    lettered = table_[:BUCKETS].sum(0) > 0
    langs, table_ = [k for k, good in zip(langs, lettered, strict=True) if good], table_[:, lettered]
    if not langs:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((len(SCRIPT_NAMES), 0), bool))
    grams, scripts = table_[:BUCKETS], table_[BUCKETS:drawn]
    logs = np.log((grams + 0.5) / (grams.sum(0) + 0.5 * BUCKETS))
    uses = scripts >= np.maximum(1, SCRIPT_SHARE * scripts.sum(0))
    uses[~uses.any(1)] = True
    return Model(langs, (logs - logs.mean(1, keepdims=True)).astype(np.float32), uses)


def label(docs: DataFrame, model: Model, text: str = "text", *, penalty: float = PENALTY, spans: bool = False, lang_as: str = "lang_pred", score_as: str = "score") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (share of letters in spans of that language) and, if asked for, ``spans``:
    first and end offset in the lower-cased text, and language. Null or letterless text: ``und``, 0, no spans.
    Columns of ``docs`` with these names are replaced; ``lang_as`` and ``score_as`` give others. Repeated rows get equal labels; texts of any
    length are read whole, slice by slice. Names beginning with an underscore are reserved. No rows: no rows."""
    kind = "array<struct<first:int,end:int,lang:string>>"
    names = [lang_as, score_as, *(["spans"] if spans else [])]
    keep = docs.drop(*names)
    columns = keep.columns
    # the text travels once, unless its column is replaced
    at = columns.index(text) if text in columns else len(columns)
    sent = keep if text in columns else docs.withColumn("_text", F.col(text)).select(*columns, "_text")
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.weights, model.uses))  # BUCKETS x languages numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        span = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))
        for batch in batches:
            texts = batch[at].to_pylist()
            got = label_texts(own, texts, penalty, spans) if own.langs else [("und", 0.0, [])] * len(texts)
            made = [batch[i] for i in range(len(columns))]
            made += [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())]
            if spans:
                made.append(pa.array([[dict(zip(("first", "end", "lang"), s, strict=True)) for s in g[2]] for g in got], span))
            yield pa.RecordBatch.from_arrays(made, [*columns, *names])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keep.schema), f"`{lang_as}` string, `{score_as}` double", *([f"spans {kind}"] if spans else [])])
    return arrow_map(sent, run, schema)


def op1_language(spark, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.filter(~held_out(F.col("doc_id"))))
    thin = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return label(thin, model).select("doc_id", "held_out", "lang_pred", "score")


def is_held_out(doc_id) -> bool:
    """The same rule outside Spark."""
    return zlib.crc32(str(doc_id).encode()) % 5 == 0
