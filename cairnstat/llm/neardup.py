"""MinHash near-dedup with an LSH forest.

Sets of word shingles are compared by Jaccard similarity. Documents with equal sets are one class from the start. The
forest is ``TREES`` orders of the classes, each by a label of ``DEPTH`` min-hashes. A class's candidates are its
neighbours with the longest common prefix in each order: ``NEIGHBOURS`` on each side, if at least ``LEAST_DEPTH`` min-hashes
agree; and the lowest class of its stretch of the region. In a sparse region that reaches all who share the least depth; in a dense one the
neighbours are those that agree deeper, so the depth adapts to the region, down to ``DEPTH``, and the number of candidates stays linear.

An order is dealt by ranges of the label, so that a region of any size is split; neighbours across the cuts are found from the few
rows at each partition's ends. Candidates whose one-bit sketches say less than ``LEAST_ESTIMATE`` go (for a pair at 0.75 that is
over four standard deviations). The rest is confirmed on full sets in two steps: each class with its best and lowest
candidate; then, after the components of those links, all candidates that still lie in different components.

Neighbours don't reach every pair of a region with more than ``NEIGHBOURS`` + 1 classes. Where such a region still holds several components,
each pair of classes of different components is compared on full sets: classes of the region's largest component with the others, and these
with each other, in blocks of ``BLOCK`` classes, so that a region of any size is split. What a block gives is only links that join
components. Regions that are one component already, as groups of copies are, cost nothing more.

So a link at similarity 0.75 is missed only if the pair agrees to the least depth in no tree, which has probability (1 - 0.75^4)^24 =
1.1e-4, or, in a region within the neighbours' reach, by its sketch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, cut, drop, table, text_hash
from .components import components

WORDS = 5
PERCENT = 75
TREES = 24
DEPTH = 8
LEAST_DEPTH = 4
NEIGHBOURS = 3
SKETCH_BITS = 128
LEAST_ESTIMATE = 0.5
SLOT = 2
BLOCK = 512
SIDE = 256
COLUMNS = 4096
BYTES_AT_ONCE = 1_000_000

_draw = np.random.default_rng(20240601)
_BYTE = _draw.integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_PLACES = _draw.integers(1, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
_SLOTS = _draw.integers(1, 1 << 63, (2, TREES * DEPTH), np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int, held: dict = {}) -> np.ndarray:  # noqa: B006
    if len(held.get(base, ())) >= n:
        return held[base][:n]
    p = np.full(max(n, BYTES_AT_ONCE), base, np.uint64)
    p[0] = 1
    p = np.multiply.accumulate(p)
    if len(p) == BYTES_AT_ONCE:  # those of a longer text go with it
        held[base] = p
    return p[:n]


def word_hashes(buffer: bytes) -> np.ndarray:
    """64-bit hash of each word of a buffer of words with one blank after each."""
    raw = np.frombuffer(buffer, np.uint8)
    ends = np.flatnonzero(raw == 32)
    starts = np.concatenate([[0], ends[:-1] + 1])
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[raw] * _powers(_BASE, len(raw)), dtype=np.uint64)])
    return mix((sums[ends] - sums[starts]) * _powers(_INVERSE, len(raw))[starts] + (ends - starts).astype(np.uint64))


def shingle_sets(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text with fewer words has its whole sequence as one; without words none."""
    out: list[np.ndarray] = []
    begin = 0
    while begin < len(texts):
        end, held = begin, 0
        while end < len(texts) and (end == begin or held + len(texts[end]) <= BYTES_AT_ONCE):
            held += len(texts[end])
            end += 1
        parts = [t.lower().split() for t in texts[begin:end]]
        buffer = b"".join(b" ".join(p) + b" " for p in parts if p)
        hashes = word_hashes(buffer) if buffer else np.zeros(0, np.uint64)
        shingled = np.zeros(len(hashes), np.uint64)
        for k in range(words):
            shingled[: max(0, len(hashes) - k)] += hashes[k:] * _PLACES[k]
        shingled = mix(shingled)
        at = 0
        for p in parts:
            n = len(p)
            if n >= words:
                out.append(np.unique(shingled[at : at + n - words + 1]))
            elif n:
                out.append(mix((hashes[at : at + n] * _PLACES[8 : 8 + n]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n)))
            else:
                out.append(np.zeros(0, np.uint64))
            at += n
        begin = end
    return out


def sketches(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each set: labels (bytes of all trees), one-bit sketch, two 64-bit hashes of the whole set. No set may be empty."""
    every = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    whole = np.stack([np.add.reduceat(mix(every + np.uint64(k)), starts) for k in (1, 2)], 1).view(np.int64)
    least = np.empty((len(sets), TREES * DEPTH), np.uint64)
    for k in range(TREES * DEPTH):
        least[:, k] = np.minimum.reduceat((every ^ _SLOTS[1, k]) * _SLOTS[0, k], starts)
    short = mix(least)
    labels = (short >> np.uint64(48)).astype(">u2").view(np.uint8).reshape(len(sets), -1)
    bits = np.packbits((short[:, :SKETCH_BITS] & np.uint64(1)).astype(np.uint8), axis=1)
    return labels, bits, whole


def sketch_documents(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc_id, th (hash of the text), n_shingles, h1, h2, labels, bits of every row; null in the last four where there is no word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                sets = shingle_sets([(t.as_py() or "").encode("utf-8", "surrogatepass") for t in part[2]])
                full = [s for s in sets if len(s)]
                at = iter(range(len(full)))
                labels, bits, whole = sketches(full) if full else (None, None, None)
                rows = [next(at) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([
                    part[0], part[1], pa.array([len(s) for s in sets], pa.int64()),
                    *(pa.array([None if r is None else int(whole[r, c]) for r in rows], pa.int64()) for c in (0, 1)),
                    *(pa.array([None if r is None else x[r].tobytes() for r in rows], pa.binary()) for x in (labels, bits))],
                    ["doc_id", "th", "n_shingles", "h1", "h2", "labels", "bits"])

    thin = docs.select(F.col(key).cast("long").alias("doc_id"), text_hash(text).alias("th"), F.col(text).alias("text"))
    return arrow_map(thin, run, "doc_id long, th long, n_shingles long, h1 long, h2 long, labels binary, bits binary")


def _pairs_in_order(tree: np.ndarray, label: np.ndarray, rep: np.ndarray, bits: np.ndarray, fresh: int) -> tuple[np.ndarray, ...]:
    """Candidates among rows in order; ``fresh``: the rows before it have met each other already."""
    n = len(rep)
    region = np.r_[True, (tree[1:] != tree[:-1]) | (label[1:, : SLOT * LEAST_DEPTH] != label[:-1, : SLOT * LEAST_DEPTH]).any(1)]
    number = np.cumsum(region)
    left, right = [], []
    for step in range(1, NEIGHBOURS + 1):
        i = np.arange(max(0, fresh - step), n - step)
        i = i[number[i] == number[i + step]]
        left.append(i)
        right.append(i + step)
    heads = np.flatnonzero(region)
    lowest = np.minimum.reduceat(rep, heads)
    hub = np.flatnonzero(rep == lowest[number - 1])
    of = np.zeros(len(heads), np.int64)
    of[number[hub] - 1] = hub
    i = np.arange(n)
    i = i[of[number - 1] != i]
    left.append(i)
    right.append(of[number[i] - 1])
    i, j = np.concatenate(left), np.concatenate(right)
    agree = SKETCH_BITS - np.bitwise_count(bits[i] ^ bits[j]).sum(1, dtype=np.int64)
    score = 2 * agree / SKETCH_BITS - 1
    good = (score >= LEAST_ESTIMATE) & (rep[i] != rep[j])
    i, j = i[good], j[good]
    return np.minimum(rep[i], rep[j]), np.maximum(rep[i], rep[j]), score[good]


_ORDER = "tree int, label binary, rep long, bits binary"


def _walk(edge: bool):
    """Partition function over rows in order. Gives pairs; with ``edge`` also the rows at both ends of the partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] | None = None
        first: list[np.ndarray] | None = None

        def ends(rows: list[np.ndarray]) -> pa.RecordBatch:
            n = len(rows[2])
            none = pa.nulls(n, pa.int64())
            return pa.RecordBatch.from_arrays([none, none, pa.nulls(n, pa.float64()), pa.array(rows[0], pa.int32()), pa.array([x.tobytes() for x in rows[1]], pa.binary()), pa.array(rows[2], pa.int64()), pa.array([x.tobytes() for x in rows[3]], pa.binary())], names)

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch[0].to_numpy(), np.frombuffer(b"".join(batch[1].to_pylist()), np.uint8).reshape(batch.num_rows, -1), batch[2].to_numpy(), np.frombuffer(b"".join(batch[3].to_pylist()), np.uint8).reshape(batch.num_rows, -1)]
            fresh = 0
            if kept is not None:
                fresh = len(kept[2])
                rows = [np.concatenate([a, b]) for a, b in zip(kept, rows, strict=True)]
            if first is None:
                first = [x[:NEIGHBOURS] for x in rows]
            a, b, score = _pairs_in_order(*rows, fresh)
            n = len(a)
            if n:
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(score), *(pa.nulls(n, k) for k in (pa.int32(), pa.binary(), pa.int64(), pa.binary()))], names)
            kept = [x[-NEIGHBOURS:] for x in rows]
        if edge and first is not None:
            yield ends(first)
            yield ends(kept)

    names = ["a", "b", "score", "tree", "label", "rep", "bits"]
    return run


def candidates(classes: DataFrame) -> DataFrame:
    """a < b and score of pairs of classes (rep, labels, bits) that the forest puts side by side."""
    wide = SLOT * DEPTH
    rows = classes.select("rep", "bits", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.substring("labels", t * wide + 1, F.lit(wide)))).alias("tree", "label"))
    # as many ranges as the session has shuffle partitions
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.select("tree", "label", "rep", "bits").repartitionByRange(parts, "tree", "label", "rep").sortWithinPartitions("tree", "label", "rep")
    met = cut(arrow_map(ranged, _walk(True), f"a long, b long, score double, {_ORDER}"), "forest")
    # NEIGHBOURS rows from either end of each partition: their number depends on that of the partitions alone
    seam = met.filter("tree is not null").select("tree", "label", "rep", "bits").distinct().repartition(1).sortWithinPartitions("tree", "label", "rep")
    across = arrow_map(seam, _walk(False), f"a long, b long, score double, {_ORDER}")
    found = cut(met.filter("a is not null").select("a", "b", "score").unionByName(across.select("a", "b", "score").filter("a is not null")).groupBy("a", "b").agg(F.max("score").alias("score")), "candidates")
    drop(met)
    return found


def packed_texts(docs: DataFrame, nodes: DataFrame, key: str, text: str) -> DataFrame:
    """rep and compressed text of the nodes (rep, doc_id, th)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch[0], pa.array([packer.compress(t.as_py().encode("utf-8", "surrogatepass")) for t in batch[1]], pa.binary())], ["rep", "body"])

    thin = docs.select(F.col(key).cast("long").alias("doc_id"), text_hash(text).alias("th"), F.col(text).alias("text")).filter("text is not null")
    # by sorting at any size: a broadcast of the nodes would grow with the documents
    own = thin.join(nodes.hint("merge"), ["doc_id", "th"]).dropDuplicates(["doc_id", "th"])
    return arrow_map(own.select("rep", "text"), run, "rep long, body binary")


def confirm(pairs: DataFrame, bodies: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = zstandard.ZstdDecompressor()
        for batch in batches:
            for k in range(0, batch.num_rows, 200):
                part = batch.slice(k, 200)
                n = part.num_rows
                sets = shingle_sets([reader.decompress(x) for c in (2, 3) for x in part[c].to_pylist()])
                good = []
                for x, y in zip(sets[:n], sets[n:], strict=True):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    good.append(bool(both) and 100 * both >= percent * (len(x) + len(y) - both))
                yield part.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    one = pairs.select("a", "b").join(bodies.select(F.col("rep").alias("a"), F.col("body").alias("body_a")), "a")
    two = one.join(bodies.select(F.col("rep").alias("b"), F.col("body").alias("body_b")), "b")
    return arrow_map(two.select("a", "b", "body_a", "body_b"), run, "a long, b long")


def crowded(classes: DataFrame) -> DataFrame:
    """region and rep of the classes of regions that have more of them than neighbours reach."""
    wide = SLOT * DEPTH
    rows = classes.select("rep", F.explode(F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.xxhash64(t, F.substring("labels", t * wide + 1, F.lit(SLOT * LEAST_DEPTH))))).alias("region"))
    # written first, so that Spark can split a large region in the join
    large = cut(rows.groupBy("region").count().filter(F.col("count") > NEIGHBOURS + 1).select("region"), "crowded-regions")
    found = cut(rows.join(large, "region"), "crowded")
    drop(large)
    return found


def blocks_of(members: DataFrame, found: DataFrame) -> DataFrame:
    """region, x, y, block, rep, root: what meets in block pair (x, y) of each region of ``members`` that holds several components.

    The region's largest component is dealt to blocks behind those of the others, and its blocks don't meet each other.
    """
    rooted = members.join(found.select(F.col("node").alias("rep"), "root"), "rep", "left").select("region", "rep", F.coalesce("root", "rep").alias("root"))
    by_root = rooted.groupBy("region", "root").count()
    each = by_root.groupBy("region").agg(F.max(F.struct("count", "root")).alias("top"), F.sum("count").alias("n")).filter("top.count < n")
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    each = cut(each.select("region", F.col("top.root").alias("largest"), blocks(F.col("n") - F.col("top.count")).alias("others"), blocks(F.col("top.count")).alias("own")), "open-regions")
    inner = F.col("root") == F.col("largest")
    salt = F.xxhash64("rep", F.lit("block"))
    held = rooted.join(each, "region").select(
        "region", "rep", "root", F.when(inner, F.col("others") + F.pmod(salt, F.col("own"))).otherwise(F.pmod(salt, F.col("others"))).cast("int").alias("block"),
        F.when(inner, F.col("others")).otherwise(F.col("others") + F.col("own")).alias("meets"))
    met = held.select("region", "rep", "root", "block", F.explode(F.sequence(F.lit(0), F.col("meets") - 1)).alias("other"))
    return met.select("region", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "rep", "root")


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each set of ``left`` has in common with each of ``right``."""
    def flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])

    (a, row_a), (b, row_b) = flat(left), flat(right)
    both = np.intersect1d(a, b)
    out = np.zeros((len(left), len(right)), np.float32)
    if not len(both):
        return out.astype(np.int64)

    def places(every: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(both, every), len(both) - 1)
        good = both[at] == every
        at, row = at[good], row[good]
        order = np.argsort(at, kind="stable")
        return at[order], row[order]

    (at_a, row_a), (at_b, row_b) = places(a, row_a), places(b, row_b)
    for k in range(0, len(both), COLUMNS):
        parts = []
        for at, row, n in ((at_a, row_a, len(left)), (at_b, row_b, len(right))):
            i, j = np.searchsorted(at, [k, k + COLUMNS])
            part = np.zeros((n, min(COLUMNS, len(both) - k)), np.float32)
            part[row[i:j], at[i:j] - k] = 1
            parts.append(part)
        out += parts[0] @ parts[1].T
    return out.astype(np.int64)


def _join_blocks(left: list[tuple], right: list[tuple], percent: int) -> list[tuple[int, int]]:
    """Links (rep, rep) that join components among the pairs of rows (rep, root, body) of two blocks; one block with itself if they are the same."""
    reader = zstandard.ZstdDecompressor()
    above: dict[int, int] = {}

    def find(x: int) -> int:
        while above.get(x, x) != x:
            x = above[x]
        return x

    out = []
    for k in range(0, len(left), SIDE):
        own = left[k : k + SIDE]
        sets = shingle_sets([reader.decompress(r[2]) for r in own])
        for m in range(k if left is right else 0, len(right), SIDE):
            others = right[m : m + SIDE]
            if len({find(r[1]) for r in own} | {find(r[1]) for r in others}) == 1:
                continue
            more = sets if left is right and m == k else shingle_sets([reader.decompress(r[2]) for r in others])
            both = _shared(sets, more)
            size = np.array([len(s) for s in sets])[:, None] + np.array([len(s) for s in more])[None, :]
            ra, rb = np.array([r[1] for r in own]), np.array([r[1] for r in others])
            i, j = np.nonzero((both > 0) & (100 * both >= percent * (size - both)) & (ra[:, None] != rb[None, :]))
            if len(i):
                for at in np.unique(np.stack([ra[i], rb[j]], 1), axis=0, return_index=True)[1].tolist():
                    p, q = own[i[at]], others[j[at]]
                    x, y = find(p[1]), find(q[1])
                    if x != y:
                        above[max(x, y)] = min(x, y)
                        out.append((p[0], q[0]))
    return out


def join_regions(met: DataFrame, bodies: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) between components that ``blocks_of`` puts together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        at = None

        def links() -> pa.RecordBatch:
            left = [r[1:] for r in held if r[0] == at[1]]
            right = left if at[1] == at[2] else [r[1:] for r in held if r[0] == at[2]]
            found = _join_blocks(left, right, percent) if left and right else []
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])

        for batch in batches:
            for *group, block, rep, root, body in zip(*(batch[i].to_pylist() for i in range(7)), strict=True):
                if group != at:
                    if held:
                        yield links()
                    held, at = [], group
                held.append((block, rep, root, body))
        if held:
            yield links()

    parts = int(met.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = met.join(bodies, "rep").select("region", "x", "y", "block", "rep", "root", "body")
    return arrow_map(rows.repartition(parts, "region", "x", "y").sortWithinPartitions("region", "x", "y"), run, "a long, b long")


def class_rows(full: DataFrame) -> DataFrame:
    """h1, h2, doc_id, th, labels, bits and ``rep`` of each class of equal sets: its first document, and the number of its node. That is
    the doc_id; where a doc_id is first in several classes, as rows of it have different texts, a hash of doc_id and text."""
    first = full.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "th", "labels", "bits")).alias("x"))
    classes = cut(first.select("h1", "h2", "x.*"), "classes")
    again = cut(classes.groupBy("doc_id").count().filter("count > 1").select("doc_id", F.lit(True).alias("again")), "repeated-keys")
    return classes.join(again, "doc_id", "left").withColumn("rep", F.when(F.col("again"), F.xxhash64("doc_id", "th")).otherwise(F.col("doc_id"))).drop("again")


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", *, percent: int = PERCENT) -> DataFrame:
    """doc_id, th (hash of the text), n_shingles, component_id, kept and ``first`` of every row.

    Null, empty and wordless texts have no shingle and are linked with nothing. Rows with equal sets are linked, repeated rows
    too. Rows with one key and different texts are documents of their own; ``first`` is true for the component's lowest (doc_id, th), and for
    rows that repeat it. ``kept`` goes by the key alone. A row with a null key is linked with nothing, kept and first. Texts of any
    length are read whole. Extra columns are left out. No rows: no rows.
    """
    sketched = cut(sketch_documents(docs, key, text), "sketches")
    full = sketched.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = class_rows(full)
    pairs = candidates(classes)
    ends = pairs.select(F.col("a").alias("rep"), F.col("b").alias("other"), "score").unionByName(pairs.select(F.col("b").alias("rep"), F.col("a").alias("other"), "score"))
    best = ends.groupBy("rep").agg(F.max_by("other", "score").alias("x"), F.min("other").alias("y"))
    best = cut(best.select("rep", F.explode(F.array_distinct(F.array("x", "y"))).alias("other")).select(F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b")).distinct(), "best")
    members = crowded(classes)
    wanted = ends.select("rep").union(members.select("rep")).distinct()
    nodes = classes.select("rep", "doc_id", "th").join(wanted, "rep")
    bodies = cut(packed_texts(docs, nodes, key, text), "bodies")
    links = cut(confirm(best, bodies, percent), "links")
    roots = cut(components(links), "roots")
    of_a = pairs.select("a", "b").join(roots.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a", "left")
    of_b = of_a.join(roots.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b", "left")
    rest = cut(of_b.filter(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b").join(best, ["a", "b"], "left_anti"), "rest")
    found = components(links.unionByName(confirm(rest, bodies, percent)))
    met = cut(blocks_of(members, found), "blocks")
    if met.limit(1).count():
        joined = join_regions(met, bodies, percent)
        found = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(joined))
    named = classes.select("h1", "h2", "doc_id", "th", "rep").join(found, F.col("rep") == F.col("node"), "left").select("h1", "h2", "doc_id", "th", F.coalesce("root", "rep").alias("root"))
    named = cut(named, "named")
    tops = cut(named.groupBy("root").agg(F.min(F.struct("doc_id", "th")).alias("top")), "tops")
    named = cut(named.join(tops, "root").select("h1", "h2", "top"), "named-tops")
    drop(pairs, best, members, bodies, links, roots, rest, met, tops)
    joined = full.join(named, ["h1", "h2"]).select("doc_id", "th", "n_shingles", F.col("top.doc_id").alias("component_id"), (F.col("top") == F.struct("doc_id", "th")).alias("first"))
    lone = sketched.filter("n_shingles = 0 OR doc_id IS NULL").select("doc_id", "th", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("first"))
    return joined.unionByName(lone).withColumn("kept", F.col("component_id").eqNullSafe(F.col("doc_id")))


def op9_neardup(spark, sf_dir: str) -> DataFrame:
    """Set size, component and verdict of every document."""
    return near_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")
