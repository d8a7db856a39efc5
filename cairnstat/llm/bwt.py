"""Burrows-Wheeler transforms of shards, merged by iterative interleave refinement.

Texts are read as strings over wide symbols: the hash of ``STEP`` bytes. A text of n bytes gives ``STEP`` strings, one for
each residue of the position, so that every byte position starts a suffix, and ``depth`` symbols of it are ``depth * STEP`` bytes.

A shard sorts its own suffixes and keeps the symbol before each. The merge knows nothing of other shards' suffixes but those symbols: it
starts with one shard after the other and refines the interleave; a round takes the symbols before all suffixes in the present order and
sorts them stably, which orders the suffixes by one symbol more. Two neighbours that a round tells apart have a common prefix of
one symbol less than that round; suffixes never told apart in ``depth`` rounds are a repeated interval. No round sorts a suffix again.

Texts may also be arrays of wider units (``dtype``), such as codes of words; what is said of bytes holds for those then.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

STEP = 40
SHARD_BYTES = 1 << 16
HELD_BYTES = 1 << 19

_draw = np.random.default_rng(20240607)
_BYTE = _draw.integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0xD6E8FEB86659FD93
_held: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def powers(base: int, n: int) -> np.ndarray:
    if len(_held.get(base, ())) >= n:
        return _held[base][:n]
    p = np.full(max(n, HELD_BYTES), base, np.uint64)
    p[0] = 1
    p = np.multiply.accumulate(p)
    if len(p) == HELD_BYTES:  # those of a longer buffer go with it
        _held[base] = p
    return p[:n]


class Rolling:
    """Hashes of any stretch of a buffer of bytes, or of codes of 64 bits."""

    def __init__(self, raw: np.ndarray):
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((_BYTE[raw] if raw.dtype == np.uint8 else raw) * powers(_BASE, len(raw)), dtype=np.uint64)])
        self.back = powers(pow(_BASE, -1, 1 << 64), len(raw) + 1)

    def plain(self, n: int) -> np.ndarray:
        """Hashes of all stretches of ``n``, good in their high bits only."""
        return (self.sums[n:] - self.sums[:-n]) * self.back[: len(self.sums) - n]

    def of(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[first]) * self.back[first] + (end - first).astype(np.uint64))


def stable_order(x: np.ndarray) -> np.ndarray:
    """Places of the numbers (not below 0) in ascending order, equal ones in their order. Number and place are sorted as one integer
    where both fit, which is several times as fast as a stable sort of places."""
    bits = max(1, (len(x) - 1).bit_length())
    if len(x) and int(x.max()).bit_length() + bits <= 63:
        return np.sort((x << bits) | np.arange(len(x))) & ((1 << bits) - 1)
    return np.argsort(x, kind="stable")


def dense(x: np.ndarray) -> np.ndarray:
    """Numbers from 0 in the order of the values, equal ones for equal values."""
    order = stable_order(x)
    ranked = x[order]
    out = np.empty(len(x), np.int64)
    out[order] = np.cumsum(np.r_[False, ranked[1:] != ranked[:-1]])
    return out


@dataclass
class Symbols:
    """Nodes of all strings: one for each byte position of each text, and one after its last byte."""

    rank: np.ndarray  # of the node's symbol; ends of strings are the lowest, each its own
    before: np.ndarray  # node before, going round
    after: np.ndarray  # node after; an end is its own
    text: np.ndarray  # number of the text
    place: np.ndarray  # position in the text


def read_symbols(texts: list[bytes], step: int = STEP, dtype: type = np.uint8) -> Symbols:
    """Every text has ``step`` bytes at least."""
    raw = np.frombuffer(b"".join(texts), dtype)
    size = np.array([len(t) for t in texts], np.int64) // raw.itemsize
    byte0 = np.cumsum(size) - size
    n = size + 1
    text = np.repeat(np.arange(len(texts)), n)
    place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    length = size[text]
    last = place + step > length
    at = np.minimum(byte0[text] + place, len(raw) - step)
    # as many bits of the hash as sort together with the place, 40 at least
    bits = max(40, 63 - max(1, (len(at) - 1).bit_length()))
    number = dense((Rolling(raw).of(at, at + step) >> np.uint64(64 - bits)).astype(np.int64))
    ends = int(last.sum())
    rank = number + ends
    rank[last] = np.arange(ends)
    node = np.arange(len(rank))
    # the end of the string that a node of the first ``step`` positions opens
    closes = node + (length - place) // step * step
    before = np.where(place >= step, node - step, closes)
    return Symbols(rank.astype(np.int64), before, np.where(last, node, node + step), text, place)


def sort_shard(s: Symbols, first: int, end: int, depth: int) -> np.ndarray:
    """Nodes of one shard in the order of their suffixes to ``depth`` symbols at least, by doubling."""
    rank, after = s.rank[first:end], s.after[first:end] - first
    known = 1
    while True:
        order = stable_order(rank)
        ranked = rank[order]
        differ = ranked[1:] != ranked[:-1]
        if known >= depth or differ.all():
            return order + first
        number = np.empty(len(rank), np.int64)
        number[order] = np.cumsum(np.r_[False, differ])
        rank = number * (int(number[order[-1]]) + 1) + number[after]
        after = after[after]
        known *= 2


@dataclass
class Merged:
    node: np.ndarray  # in suffix order
    interval: np.ndarray  # equal for suffixes that agree in ``depth`` symbols
    lcp: np.ndarray  # symbols shared with the suffix before, ``depth`` for that or more


def merge_shards(symbols_before: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Interleave of the shards (which shard each place belongs to), intervals and common prefixes, from the shards' transforms."""
    sizes = [len(x) for x in symbols_before]
    every = np.concatenate(symbols_before)
    shard = np.repeat(np.arange(len(sizes), dtype=np.uint16), sizes)
    interval = np.zeros(len(every), np.int64)
    lcp = np.full(len(every), depth, np.int64)
    for k in range(depth):
        within = np.empty(len(every), np.int64)
        within[np.argsort(shard, kind="stable")] = np.arange(len(every))
        seen = every[within]
        order = stable_order(seen)
        seen, was, shard = seen[order], interval[order], shard[order]
        new = np.r_[True, (seen[1:] != seen[:-1]) | (was[1:] != was[:-1])]
        lcp[new & (lcp == depth)] = k
        interval = np.cumsum(new) - 1
    return shard, interval, lcp


def repeated(texts: list[bytes], depth: int, shard_bytes: int = SHARD_BYTES, step: int = STEP, dtype: type = np.uint8) -> tuple[Symbols, Merged]:
    """Suffixes of all texts in one order, from shards of about ``shard_bytes``."""
    s = read_symbols(texts, step, dtype)
    cuts = [0]
    stops = np.flatnonzero(np.r_[s.text[1:] != s.text[:-1], True]) + 1
    for stop in stops.tolist():
        if stop - cuts[-1] >= shard_bytes or stop == len(s.text):
            cuts.append(stop)
    orders = [sort_shard(s, a, b, depth) for a, b in zip(cuts, cuts[1:], strict=False)]
    shard, interval, lcp = merge_shards([s.rank[s.before[o]] for o in orders], depth)
    node = np.empty(len(shard), np.int64)
    node[np.argsort(shard, kind="stable")] = np.concatenate(orders)
    return s, Merged(node, interval, lcp)
