"""Packing pieces of documents into sequences: best fit, then swap-based local search.

Only lengths matter for packing, and there are at most ``room`` of them. So the plan is made on the driver from the count of
each length: sequences with the same lengths in them are one pattern with a count. Best fit in descending length fills the
patterns; then the local search takes the emptiest underfull pattern and moves a document, exchanges one for one, or two for one,
with fuller underfull patterns, each time such that the sum of squared fills grows, until sequences are empty and vanish or no
exchange raises it.

The plan goes back as runs: of each length, ranks ``first`` to ``end`` go to consecutive sequences at one offset. Ranks within
a length are counted within cells. A length has as many cells as its share of the rows asks for, so that one that a third of all
documents share is split over many tasks: CELLS and one for each length in all, and more once a cell would have over CELL_ROWS rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import codec
from .common import arrow_map, cut, table, tokenizer_path

ROOM = 4096
CELLS = 4096
CELL_ROWS = 1_000_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def best_fit(counts: dict[int, int], room: int = ROOM) -> Counter[tuple[int, ...]]:
    """Patterns (lengths, descending) with counts by best fit in descending length. Equal lengths go in bulk, as one after
    the other would."""
    held: dict[int, list[list]] = defaultdict(list)  # by room left: [pattern, count]
    left: list[int] = []

    def put(pattern: tuple[int, ...], n: int, rest: int) -> None:
        if n:
            if not held[rest]:
                insort(left, rest)
            held[rest].append([pattern, n])

    for size in sorted(counts, reverse=True):
        n = counts[size]
        while n:
            at = bisect_left(left, size)
            if at == len(left):
                each, bins, rest, pattern = room // size, None, room, ()
            else:
                rest = left[at]
                pattern, bins = held[rest].pop()
                if not held[rest]:
                    left.pop(at)
                each = rest // size
            whole = n // each if bins is None else min(bins, n // each)
            put(pattern + (size,) * each, whole, rest - size * each)
            n -= whole * each
            spare = bins is None or bins > whole
            if n and n < each and spare:
                put(pattern + (size,) * n, 1, rest - size * n)
                n, whole = 0, whole + 1
            if bins is not None:
                put(pattern, bins - whole, rest)
    out: Counter[tuple[int, ...]] = Counter()
    for patterns in held.values():
        for pattern, n in patterns:
            out[pattern] += n
    return out


def _gives(a: tuple[int, ...]) -> np.ndarray:
    """What a sequence can give in an exchange: the lengths of one document, and of two, ascending."""
    one, n = np.unique(np.array(a, np.int64), return_counts=True)
    i, k = np.triu_indices(len(one))
    fits = (i != k) | (n[i] > 1)
    return np.unique(np.r_[one, one[i[fits]] + one[k[fits]]])


def _taken(a: tuple[int, ...], give: int) -> tuple[int, ...]:
    """The one document or two of ``a`` that are ``give`` long together."""
    if give in a:
        return (give,)
    left = Counter(a)
    return next((x, give - x) for x in a if left[give - x] > (x == give - x))


class _Partners:
    """What underfull sequences offer in an exchange: a row for each length they would give back, 0 for a plain move.

    ``target`` is what the other side may give at most: the room left and what is given back. Rows are in order of their pattern's serial number, so
    those that came after a sequence was tried are the end of the table. Patterns without sequences are deleted at times.
    """

    def __init__(self) -> None:
        self.patterns: dict[int, tuple[int, ...]] = {}
        self.serials: dict[tuple[int, ...], int] = {}
        self.next, self.size, self.dead = 0, 0, 0
        self.rows = np.zeros((3, 1024), np.int64)  # serial, target, given back

    def add(self, pattern: tuple[int, ...], room: int) -> None:
        self.remove(pattern)
        back = np.r_[0, np.unique(np.array(pattern, np.int64))]
        end = self.size + len(back)
        if end > self.rows.shape[1]:
            self.rows = np.concatenate([self.rows, np.zeros((3, max(end, self.size)), np.int64)], 1)
        self.rows[0, self.size : end] = self.next
        self.rows[1, self.size : end] = room - sum(pattern) + back
        self.rows[2, self.size : end] = back
        self.patterns[self.next], self.serials[pattern] = pattern, self.next
        self.next, self.size = self.next + 1, end

    def remove(self, pattern: tuple[int, ...]) -> None:
        serial = self.serials.pop(pattern, None)
        if serial is None:
            return
        del self.patterns[serial]
        first, end = np.searchsorted(self.rows[0, : self.size], [serial, serial + 1])
        self.rows[1, first:end] = -1
        self.dead += int(end - first)
        if 2 * self.dead > self.size:
            live = self.rows[:, : self.size][:, self.rows[1, : self.size] >= 0]
            self.size, self.dead = live.shape[1], 0
            self.rows[:, : self.size] = live

    def best(self, a: tuple[int, ...], since: int, alone: bool, room: int) -> tuple[tuple[int, ...], int, int] | None:
        """Partner, length given and length given back that leave the partner fullest, of partners as full as ``a`` or fuller whose serial is
        ``since`` or later; a move gives one document. None if no exchange raises the squared fill."""
        first = int(np.searchsorted(self.rows[0, : self.size], since))
        serial, target, back = self.rows[:, first : self.size]
        slack = target - back
        at = np.flatnonzero((target >= 0) & (slack <= room - sum(a)) & (serial != (self.serials.get(a, -1) if alone else -1)))
        if not len(at):
            return None
        target, back = target[at], back[at]
        gives, ones = _gives(a), np.unique(np.array(a, np.int64))
        pick = lambda have: np.r_[0, have][np.searchsorted(have, target, "right")]
        give = np.where(back == 0, pick(ones), pick(gives))
        rest = np.where(give > back, target - give, room + 1)
        k = int(rest.argmin())
        if rest[k] > room:
            return None
        return self.patterns[int(serial[at[k]])], int(give[k]), int(back[k])


def local_search(patterns: Counter[tuple[int, ...]], room: int = ROOM) -> Counter[tuple[int, ...]]:
    """Exchange between underfull sequences until no sequence can empty or no exchange helps; full ones stay.

    Tried are moving a document, one for one, and two for one. The emptiest sequence gives to the partner that ends up fullest; its own rest is
    looked at again. One that can give nothing is set aside, and comes back for the partners that exchanges have made since. The sum of
    squared fills grows with each exchange, so it ends.
    """
    done = Counter({p: n for p, n in patterns.items() if sum(p) == room})
    under = Counter({p: n for p, n in patterns.items() if sum(p) < room})
    bins = under.total()
    least = -(-sum(sum(p) * n for p, n in under.items()) // room)
    partners = _Partners()
    for p in sorted(under, key=lambda p: (-sum(p), p)):
        partners.add(p, room)
    tried = dict.fromkeys(under, 0)  # serial up to which a pattern's partners have been tried
    queue = [(sum(p), p) for p in under]
    heapify(queue)

    def change(p: tuple[int, ...], n: int) -> None:
        nonlocal bins
        if not p:
            return
        bins += n
        if sum(p) == room:
            done[p] += n
            return
        before = under[p]
        under[p] += n
        if not under[p]:
            del under[p]
            partners.remove(p)
        elif n > 0 and before < 2:  # new, or the first that can be its own partner
            partners.add(p, room)
            if not before:
                tried[p] = 0
            heappush(queue, (sum(p), p))

    while bins > least:
        if not queue:
            queue = [(sum(p), p) for p in under if tried[p] < partners.next]
            heapify(queue)
            if not queue:
                break
        _, a = heappop(queue)
        if not under[a]:
            continue
        found = partners.best(a, tried[a], under[a] == 1, room)
        if found is None:
            tried[a] = partners.next
            continue
        b, give, back = found
        n = under[a] // 2 if a == b else min(under[a], under[b])
        less, more = Counter(a), Counter(b)
        for x in _taken(a, give):
            less[x] -= 1
            more[x] += 1
        if back:
            more[back] -= 1
            less[back] += 1
        change(a, -n)
        change(b, -n)
        for c in (less, more):
            change(tuple(sorted(c.elements(), reverse=True)), n)
        if under[a]:
            heappush(queue, (sum(a), a))
    return done + under


def plan(counts: dict[int, int], room: int = ROOM) -> tuple[np.ndarray, int]:
    """Rows (length, first rank, end rank, first sequence, offset), sorted by length and rank; number of sequences."""
    patterns = local_search(best_fit(counts, room), room)
    used: Counter[int] = Counter()
    rows, bins = [], 0
    for pattern in sorted(patterns, reverse=True):
        n, offset = patterns[pattern], 0
        for size in pattern:
            rows.append((size, used[size], used[size] + n, bins, offset))
            used[size] += n
            offset += size
        bins += n
    return np.array(sorted(rows), np.int64).reshape(-1, 5), bins


def pieces_of(docs: DataFrame, tokenizer: str, end: int | None, room: int = ROOM, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32. Null and empty texts have the end id only."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer)
        tail = b"" if end is None else np.array([end], "<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            for doc, t in zip(batch[0].to_pylist(), batch[1], strict=True):
                ids = own.ids(t.as_py()) + tail
                rows += [(doc, k, k * room, (min(len(ids), (k + 1) * room * 4) - k * room * 4) // 4, zlib.crc32(ids[k * room * 4 : (k + 1) * room * 4])) for k in range(-(-len(ids) // (room * 4)))]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return arrow_map(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")), run, PIECES, keeps=tokenizer)


def pack(pieces: DataFrame, room: int = ROOM) -> DataFrame:
    """``pieces`` (with doc_id, piece, length; each length from 1 to ``room``) with ``sequence_id`` and ``offset``.

    Its rows are read several times, so cut their lineage first. Rows equal in all columns are packed like any others; further columns stay,
    and names beginning with an underscore are reserved. No rows: no rows.
    """
    spark = pieces.sparkSession
    lengths = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # room rows at most
    each = min(CELL_ROWS, -(-sum(lengths.values()) // CELLS)) or 1
    salts = spark.createDataFrame([(int(k), -(-n // each)) for k, n in lengths.items()], "length long, _salts int")
    salted = pieces.join(F.broadcast(salts), "length").select(*pieces.columns, F.pmod(F.xxhash64("doc_id", "piece", F.lit("pack")), F.col("_salts")).cast("int").alias("_salt"))
    counted = salted.groupBy("length", "_salt").count().toArrow()  # a row for each cell
    size, salt, n = (counted[i].to_numpy() for i in range(3))
    order = np.lexsort((salt, size))
    size, salt, n = size[order], salt[order], n[order]
    before = np.cumsum(n) - n
    heads = np.flatnonzero(np.r_[True, np.diff(size) != 0]) if len(size) else np.zeros(0, np.int64)
    before -= np.repeat(before[heads], np.diff(np.r_[heads, len(size)]))
    runs, _ = plan({int(k): int(v) for k, v in lengths.items()}, room)
    shared = spark.sparkContext.broadcast((size << 32 | salt, before, runs))
    ranked = salted.withColumn("_rank", F.row_number().over(Window.partitionBy("length", "_salt").orderBy("doc_id", "piece")) - 1)
    names = [f.name for f in pieces.schema if f.name not in ("sequence_id", "offset")]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema if f.name in names), "sequence_id long, offset long"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ahead, table_ = shared.value
        starts = table_[:, 0] << 44 | table_[:, 1]
        for batch in batches:
            columns = [batch[k] for k in range(batch.num_columns - 3)]
            length, salt_, rank = (batch[batch.num_columns - 3 + k].to_numpy() for k in range(3))
            rank = rank + ahead[np.searchsorted(keys, length << 32 | salt_)]
            run = table_[np.searchsorted(starts, length << 44 | rank, "right") - 1]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(run[:, 3] + rank - run[:, 1]), pa.array(run[:, 4])], [*names, "sequence_id", "offset"])

    return arrow_map(ranked.select(*names, F.col("length").alias("_length"), "_salt", "_rank"), place, schema)


def op6_packing(spark, sf_dir: str) -> DataFrame:
    """Place of every piece of every document."""
    pieces = pieces_of(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), 1)
    return pack(cut(pieces, "pieces"))
