"""Consistent-hash ring with virtual nodes and bounded loads.

Every key has a place on a ring of ``cells``; every shard has ``vnodes`` points there. A key belongs to the first point
clockwise. A shard takes keys until its bound; keys that overflow continue clockwise to the next point whose shard has
room. The bounds add up to the number of rows, so that the counts of any two shards differ by one at most, and a key
moves only where its own shard was full.

The only thing gathered on the driver is the number of keys in each cell: ``cells`` numbers, whatever the input. The
plan made from them has at most ``cells + shards * (shards * vnodes)`` ranges, which is the bound of the broadcast.
Within a cell the rows are ranked by hash, so no task gets more than its cells.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import table, utf8

CELLS = 16384
VNODES = 64


def ring_points(shards: int, vnodes: int, cells: int) -> list[tuple[int, int]]:
    """Sorted (cell, shard) of all virtual nodes; two in the same cell keep their order by shard."""
    def place(label: str) -> int:
        return int.from_bytes(hashlib.sha256(label.encode()).digest()[:8], "big") % cells

    return sorted((place(f"shard-{s}/{v}"), s) for s in range(shards) for v in range(vnodes))


def assign_ranges(counts: dict[int, int], shards: int, vnodes: int, cells: int) -> list[tuple[int, int, int, int, int]]:
    """(cell, first rank, end rank, shard, slot of the first) so that every key has one place.

    First every shard takes the keys of its own arcs in ring order up to its bound, then the overflow of each cell walks
    clockwise. Both passes go through the ring from cell 0, so the plan depends on the counts alone.
    """
    total = sum(counts.values())
    free = [total // shards + (s < total % shards) for s in range(shards)]
    used = [0] * shards
    points = ring_points(shards, vnodes, cells)
    places = [c for c, _ in points]
    ranges: list[tuple[int, int, int, int, int]] = []
    over: list[tuple[int, int, int]] = []

    def take(cell: int, first: int, end: int, shard: int) -> int:
        n = min(end - first, free[shard])
        if n:
            ranges.append((cell, first, first + n, shard, used[shard]))
            used[shard] += n
            free[shard] -= n
        return first + n

    for cell in sorted(counts):
        at = bisect_left(places, cell) % len(points)
        first = take(cell, 0, counts[cell], points[at][1])
        if first < counts[cell]:
            over.append((cell, first, counts[cell]))
    for cell, first, end in over:
        at = bisect_left(places, cell)
        while first < end:
            first = take(cell, first, end, points[at % len(points)][1])
            at += 1
    return ranges


def shard_rows(df: DataFrame, key: str, shards: int = 16, *, vnodes: int = VNODES, cells: int = CELLS, tie: str | None = None) -> DataFrame:
    """``df`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard).

    Rows with equal keys share a cell and are ranked by ``tie`` (another column); rows equal in both are
    interchangeable. A null key has a place like any other. No rows: no rows. Columns of ``df`` named shard and slot are replaced.
    """
    df = df.drop("shard", "slot")
    if shards < 1 or vnodes < 1 or cells < 1:
        raise ValueError("shards, vnodes and cells are at least 1")
    spark = df.sparkSession
    place = F.xxhash64(F.col(key).cast("string"), F.lit("ring"))
    placed = df.withColumns({"_h": place, "_cell": F.pmod(place, F.lit(cells)).cast("int")})
    counts = {r[0]: r[1] for r in placed.groupBy("_cell").count().collect()}  # at most ``cells`` rows
    plan = spark.createDataFrame(assign_ranges(counts, shards, vnodes, cells), "_c int, _first long, _end long, shard int, _slot long")
    order = [F.col("_h"), F.col(key), *([F.col(tie)] if tie else [])]
    ranked = placed.withColumn("_rank", F.row_number().over(Window.partitionBy("_cell").orderBy(*order)) - 1)
    inside = (F.col("_cell") == F.col("_c")) & (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_end"))
    joined = ranked.join(F.broadcast(plan), inside)
    return joined.withColumn("slot", F.col("_slot") + F.col("_rank") - F.col("_first")).drop("_h", "_cell", "_rank", "_c", "_first", "_end", "_slot")


def op8_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents over shards 0 to 15 under the law ``rows``: counts are at most one apart."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(utf8(F.col("text"))).alias("text_crc32"),
    )
    return shard_rows(docs, "doc_id", 16, tie="text_crc32").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
