"""Descriptive statistics: one row per variable, by groups and in total.

Statistics that add up go through one wide aggregation over grouping sets, whatever the number of variables, and its few rows are
turned into one per variable afterwards. Percentiles have a branch of their own (percentiles.py), joined on the keys.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import require
from ..frames import resolve
from ..functions.expressions import filter_rows
from ..functions.labels import clean_label, stat_label
from .percentiles import percentiles
from .present import with_formats
from .select import row_window
from .weights import Weight, weighted

DEFAULT_STATS = ("count", "mean", "median", "min", "max")
TOTAL = -1
TOTAL_TEXT = "Total"


@dataclass(frozen=True)
class Context:
    """What a statistic may use: the value, its weight, the kind of weight, the row order."""

    x: Column
    w: Column
    kind: str | None
    order: Column | None

    @property
    def n(self) -> Column:
        return F.count(self.x) if self.kind in (None, "aweight") else F.sum(F.when(self.x.isNotNull(), self.w))

    @property
    def sum_w(self) -> Column:
        return F.sum(F.when(self.x.isNotNull(), self.w))

    @property
    def mean(self) -> Column:
        return F.avg(self.x) if self.kind is None else F.try_divide(F.sum(self.w * self.x), self.sum_w)

    @property
    def sd(self) -> Column:
        require(self.kind != "pweight", 198, "sd is not allowed with pweights")
        if self.kind is None:
            return F.stddev_samp(self.x)
        # sum of w (x - weighted mean)^2 by co-moments about the plain means, which Spark merges without cancellation
        n, w = F.count(self.x), F.when(self.x.isNotNull(), self.w)
        lean = n * F.covar_pop(w, self.x)
        spread = n * F.covar_pop(w * self.x, self.x) - F.avg(self.x) * lean - F.try_divide(lean * lean, self.sum_w)
        spread = F.greatest(spread, F.lit(0.0))
        if self.kind == "aweight":
            return F.sqrt(F.try_divide(F.try_divide(spread * F.count(self.x), self.sum_w), F.count(self.x) - F.lit(1.0)))
        return F.sqrt(F.try_divide(spread, self.sum_w - 1))


def _count(c: Context) -> Column:
    return c.n.cast("long") if c.kind in (None, "aweight", "fweight") else F.coalesce(c.n, F.lit(0.0))


def _sum(c: Context) -> Column:
    if c.kind is None:
        return F.coalesce(F.sum(c.x), F.lit(0.0))
    plain = F.sum(c.w * c.x)
    return F.coalesce(F.try_divide(plain * F.count(c.x), c.sum_w) if c.kind == "aweight" else plain, F.lit(0.0))


def _at(pick: Callable, present: bool) -> Callable[[Context], Column]:
    def stat(c: Context) -> Column:
        require(c.order is not None, 198, "first and last need an order of the rows (order_by)")
        return pick(c.x, F.when(c.x.isNotNull(), c.order) if present else c.order)

    return stat


#: Statistics that add up, by name. More can be put in.
STATS: dict[str, Callable[[Context], Column]] = {
    "count": _count,
    "mean": lambda c: c.mean,
    "sd": lambda c: c.sd,
    "semean": lambda c: c.sd / F.sqrt(c.n),
    "sebinomial": lambda c: F.sqrt(F.try_divide(F.when(c.mean.between(0, 1), c.mean * (1 - c.mean)), c.n)),
    "sepoisson": lambda c: F.sqrt(F.try_divide(F.when(c.mean >= 0, c.mean), c.n)),
    "sum": _sum,
    "rawsum": lambda c: F.coalesce(F.sum(c.x), F.lit(0.0)),
    "max": lambda c: F.max(c.x),
    "min": lambda c: F.min(c.x),
    "first": _at(F.min_by, False),
    "last": _at(F.max_by, False),
    "firstnm": _at(F.min_by, True),
    "lastnm": _at(F.max_by, True),
}


def percentile_numbers(stats: Sequence[str]) -> dict[str, tuple[int, ...]]:
    """Percentiles that each of the other statistics needs."""
    out: dict[str, tuple[int, ...]] = {}
    for s in stats:
        if s == "median":
            out[s] = (50,)
        elif s == "iqr":
            out[s] = (25, 75)
        elif m := re.fullmatch(r"p([1-9]\d?)", s):
            out[s] = (int(m[1]),)
    return out


def numeric(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.NumericType, T.BooleanType))


def value_of(df: DataFrame, name: str) -> Column:
    """A variable as double; NaN counts as missing."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(name), F.col(name)).cast("double")
    return (F.col(name).cast("int") if isinstance(kind, T.BooleanType) else F.col(name)).cast("double")


def prepare(df: DataFrame, variables: Sequence[str], where, window, order_by, weight: Weight | None, nomiss: bool) -> DataFrame:
    """Rows that count: the window first, then the filter, weights, and complete rows if asked for."""
    if window:
        require(order_by is not None, 198, "a row window needs an order of the rows (order_by)")
        df = row_window(df, *window, order_by)
    df = weighted(filter_rows(df, where), weight)
    return df.dropna(subset=list(variables)) if nomiss else df


def check_total_code(df: DataFrame, by: Sequence[str]) -> None:
    codes = [c for c in by if numeric(df, c)]
    if codes:
        taken = None
        for c in codes:
            taken = (F.col(c) == TOTAL) if taken is None else taken | (F.col(c) == TOTAL)
        require(df.filter(taken).limit(1).count() == 0, 198, f"the code {TOTAL} of the total occurs in {', '.join(codes)}")


def total_of(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    return F.lit(TOTAL_TEXT) if isinstance(kind, T.StringType) else F.lit(TOTAL).cast(kind)


def summarize(
    source: DataFrame | str, variables: str | Sequence[str], *, by: str | Sequence[str] = (), stats: Sequence[str] | None = None, where: str | Column | None = None, window: tuple[int, int] | None = None,
    order_by: str | None = None, weight: Weight | None = None, nomiss: bool = False, fast: bool = False, subtotals: bool = False, sort: bool = True, format: str | None = None, save: str | None = None, excel: dict | None = None, replace: bool = False,
) -> DataFrame:
    """by..., varname, varlab and a column for each statistic; with ``by`` the grand total has the code -1 (text groups: Total).

    Rows whose group is null count in the total alone. ``fast`` uses approximate percentiles, but exact ones with weights. ``first`` and ``last`` of rows
    that tie in ``order_by`` are any of them. ``subtotals`` adds the totals
    of leading groups. ``format`` is a display format for numbers, or ``auto``. ``save`` writes a workbook as well.
    """
    df = resolve(source)
    variables = variables.split() if isinstance(variables, str) else list(variables)
    by = by.split() if isinstance(by, str) else list(by)
    stats = list(stats or DEFAULT_STATS)
    require(save is not None or not (excel or replace), 198, "excel and replace need save")
    for v in [*variables, *by]:
        require(v in df.columns, 111, f"variable {v} not found")
    for v in variables:
        require(numeric(df, v), 111, f"variable {v} is not numeric")
    ranks = percentile_numbers(stats)
    for s in stats:
        require(s in STATS or s in ranks or s == "percent", 198, f"unknown statistic {s}")
    rows = prepare(df, variables, where, window, order_by, weight, nomiss)
    if by:
        check_total_code(rows, by)
    sets = [by[:k] for k in range(len(by), -1, -1)] if subtotals else [by, []]
    result = _wide(df, rows, variables, by, [s for s in stats if s in STATS or s == "percent"], weight, order_by, sets)
    if ranks:
        ps = sorted({p for need in ranks.values() for p in need})
        # the sketch takes no weights; weighted ranks are exact
        found = (_fast_ranks if fast and weight is None else _ranks)(df, rows, variables, by, ps, sets)
        result = result.join(found, [*by, "varname"], "left")
    made = {"median": F.col("p50") if 50 in {p for need in ranks.values() for p in need} else None, "iqr": F.col("p75") - F.col("p25") if "iqr" in ranks else None}
    labels = {v: clean_label((df.schema[v].metadata or {}).get("label", "")) for v in variables}
    varlab = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])[F.col("varname")]
    out = result.select(
        *[F.col(c).alias(c, metadata=_group_meta(df, c)) for c in by], F.col("varname").alias("varname", metadata={"label": "Variable"}),
        varlab.alias("varlab", metadata={"label": "Variable label"}), *[(made[s] if s in made else F.col(s)).alias(s, metadata={"label": stat_label(s)}) for s in stats])
    if sort:
        out = out.orderBy(*[F.col(c).asc_nulls_last() for c in [*by, "varname", "varlab"]])
    if format:
        out = with_formats(out, None if format == "auto" else format)
    if save:
        from ..sources.xlsx import save_tables

        save_tables({(excel or {}).get("sheet", "dtstat_output"): out}, save, replace=replace)
    return out


def _group_meta(df: DataFrame, name: str) -> dict:
    meta = dict(df.schema[name].metadata or {})
    return meta | {"value_labels": {**meta.get("value_labels", {}), str(TOTAL): TOTAL_TEXT}}


def _wide(df, rows, variables, by, stats, weight, order_by, sets) -> DataFrame:
    order = F.col(order_by) if order_by else None
    made = []
    for v in variables:
        c = Context(value_of(df, v), F.col("_w"), weight.kind if weight else None, order)
        made.append(F.struct(F.lit(v).alias("varname"), F.count(c.x).alias("_n"), *[STATS[s](c).alias(s) for s in stats if s != "percent"]).alias(f"_v{len(made)}"))
    names = [f"_v{k}" for k in range(len(variables))]
    if by:
        grouped = rows.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in by]).agg(*made, *[F.grouping(c).alias(f"_g{k}") for k, c in enumerate(by)])
        keep = None
        for k, c in enumerate(by):
            here = (F.col(f"_g{k}") == 1) | F.col(c).isNotNull()
            keep = here if keep is None else keep & here
        grouped = grouped.filter(keep).withColumns({c: F.when(F.col(f"_g{k}") == 1, total_of(df, c)).otherwise(F.col(c)) for k, c in enumerate(by)})
    else:
        grouped = rows.agg(*made)
    marks = [f"_g{k}" for k in range(len(by))]
    long = grouped.select(*by, *marks, F.explode(F.array(*names)).alias("_s")).select(*by, *marks, "_s.*")
    if "percent" in stats:
        share = Window.partitionBy("varname", *marks)
        long = long.withColumn("percent", F.try_divide(100.0 * F.col("_n"), F.sum("_n").over(share).cast("double")))
    return long.drop("_n", *marks)


def _values(df, rows, variables, by) -> DataFrame:
    """One row per group, variable and value with the sum of weights."""
    long = rows.select(*by, "_w", F.explode(F.array(*[F.struct(F.lit(v).alias("varname"), value_of(df, v).alias("x")) for v in variables])).alias("_s")).select(*by, "_w", "_s.*")
    return long.filter("x is not null").groupBy(*by, "varname", "x").agg(F.sum("_w").alias("w"))


def _ranks(df, rows, variables, by, ps, sets) -> DataFrame:
    values = _values(df, rows, variables, by)
    out = None
    for kept in sets if by else [[]]:
        part = values if len(kept) == len(by) else values.groupBy(*kept, "varname", "x").agg(F.sum("w").alias("w"))
        for c in kept:
            part = part.filter(F.col(c).isNotNull())
        part = part.select(*[F.col(c) if c in kept else total_of(df, c).alias(c) for c in by], "varname", "x", "w")
        out = part if out is None else out.unionByName(part)
    return percentiles(out, [*by, "varname"], ps)


def _fast_ranks(df, rows, variables, by, ps, sets) -> DataFrame:
    aggs = [F.percentile_approx(value_of(df, v), [p / 100 for p in ps]).alias(f"_v{k}") for k, v in enumerate(variables)]
    grouped = rows.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in by]).agg(*aggs, *[F.grouping(c).alias(f"_g{k}") for k, c in enumerate(by)]) if by else rows.agg(*aggs)
    for k, c in enumerate(by):
        grouped = grouped.filter((F.col(f"_g{k}") == 1) | F.col(c).isNotNull()).withColumn(c, F.when(F.col(f"_g{k}") == 1, total_of(df, c)).otherwise(F.col(c)))
    long = grouped.select(*by, F.explode(F.array(*[F.struct(F.lit(v).alias("varname"), F.col(f"_v{k}").alias("q")) for k, v in enumerate(variables)])).alias("_s"))
    return long.select(*by, "_s.varname", *[F.col("_s.q")[k].alias(f"p{p}") for k, p in enumerate(ps)])
