"""Exact percentiles by the rule of ranks, spread over many tasks.

Rule: order x, let W be the sum of weights and c the running sum. The percentile p is the first x with c > W p / 100; where some c
equals W p / 100, it is the mean of that x and the next one.

Equal values are added up first. Each group's values are then cut into bins at approximate quantiles (a sketch that combines before
the shuffle); the weights of the bins tell which bins hold a percentile, and only these go on. Large tables are narrowed so several
times, each level to about a sixty-fourth, until a bin fits a task; the rest is ranked. The result doesn't depend on where the
bins are cut, nor on the number of levels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS = 64
LEAF = 256 << 20
MOST_LEVELS = 4


def _on_target(before: Column, after: Column, total: Column, p: int) -> Column:
    return (before * 100 <= total * p) & (after * 100 >= total * p)


def levels_for(values: DataFrame) -> int:
    """Levels that leave about LEAF bytes to a bin, by the optimizer's estimate of the input."""
    size = int(str(values._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    levels, left = 1, size // BINS
    while left > LEAF and levels < MOST_LEVELS:
        levels, left = levels + 1, left // BINS
    return levels


def percentiles(values: DataFrame, keys: list[str], ps: list[int], x: str = "x", w: str = "w", levels: int | None = None) -> DataFrame:
    """keys and ``p<n>`` of each n in ``ps``. ``values`` has one row per key and value, with no null in keys and value."""
    ranked, path = values, []
    for level in range(levels or levels_for(values)):
        within = [*keys, *path]
        sums = [F.percentile_approx(x, [k / BINS for k in range(1, BINS)], 1000).alias("_cuts")]
        cuts = ranked.groupBy(*within).agg(*sums, *([] if level else [F.sum(w).alias("_total")]))
        name = f"_bin{level}"
        binned = ranked.join(cuts, within).withColumn(name, F.size(F.filter("_cuts", lambda c: c < F.col(x)))).drop("_cuts")
        ahead = Window.partitionBy(*within).orderBy(name).rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum("_held").over(ahead), F.lit(0))
        bins = binned.groupBy(*within, name).agg(F.sum(w).alias("_held"), F.first("_total").alias("_t"), *([F.first("_before").alias("_was")] if level else []))
        bins = bins.withColumn("_before", before + F.col("_was") if level else before)
        wanted = None
        for p in ps:
            hit = _on_target(F.col("_before"), F.col("_before") + F.col("_held"), F.col("_t"), p)
            wanted = hit if wanted is None else wanted | hit
        path.append(name)
        ranked = binned.drop("_before").join(bins.filter(wanted).select(*within, name, "_before"), [*within, name])
    inside = Window.partitionBy(*keys, *path).orderBy(x).rowsBetween(Window.unboundedPreceding, 0)
    ranked = ranked.withColumn("_c", F.col("_before") + F.sum(w).over(inside))
    total, now = F.col("_total"), F.col("_c")

    def chosen(p: int) -> Column:
        here = (now * 100 > total * p) & ((now - F.col(w)) * 100 <= total * p) | (now * 100 == total * p)
        return F.avg(F.when(here, F.col(x))).alias(f"p{p}")

    return ranked.groupBy(*keys).agg(*[chosen(p) for p in ps])
