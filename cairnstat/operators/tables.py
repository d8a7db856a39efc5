"""One-way and two-way frequency tables.

All variables and strata are counted in one aggregation over grouping sets; a two-way table's cells are conditional sums in the same
aggregation. Proportions and totals are windows over its result, which has a row per variable and value.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..errors import require
from ..frames import resolve
from ..functions.labels import number_text, suffix
from .present import with_formats
from .summary import _group_meta, check_total_code, numeric, prepare, total_of, value_of
from .weights import Weight

MOST_LEVELS = 1000


def cross_levels(df: DataFrame, cross: str) -> list[float]:
    """Distinct levels in order; an error beyond MOST_LEVELS."""
    rows = df.select(value_of(df, cross).alias("v")).filter("v is not null").distinct().limit(MOST_LEVELS + 1).collect()
    require(len(rows) <= MOST_LEVELS, 198, f"{cross} has more than {MOST_LEVELS} levels")
    return sorted(r[0] for r in rows)


def _validate(df, variables, by, cross, stats, types, save, excel, replace) -> None:
    require(save is not None or not (excel or replace), 198, "excel and replace need save")
    require(cross is not None or stats is None, 198, "stats needs cross")
    for given, allowed, name in ((stats or (), ("row", "col", "cell"), "stats"), (types or (), ("prop", "pct"), "type")):
        require(len(set(given)) == len(given), 198, f"{name} repeats a word")
        require(set(given) <= set(allowed), 198, f"{name} may hold {', '.join(allowed)}")
    require(by is None or by != cross, 198, "by and cross are the same variable")
    for v in [*variables, *([by] if by else []), *([cross] if cross else [])]:
        require(v in df.columns, 111, f"variable {v} not found")
        require(numeric(df, v), 111, f"variable {v} is not numeric")


def value_labels(df: DataFrame, variables: Sequence[str]) -> dict[str, dict[str, str]]:
    return {v: (df.schema[v].metadata or {}).get("value_labels", {}) for v in variables}


def _label_column(labels: dict[str, dict[str, str]], text: Column) -> Column:
    pairs = [F.lit(x) for v, own in labels.items() for k, t in own.items() for x in (f"{v}|{k}", t)]
    return F.coalesce(F.create_map(*pairs)[F.concat(F.col("varname"), F.lit("|"), text)], text) if pairs else text


def check_binary(rows: DataFrame, df: DataFrame, variables: Sequence[str], labels: dict[str, dict[str, str]]) -> list[tuple[float, str]]:
    """The two values with labels that all variables share."""
    found = rows.select(F.explode(F.array(*[F.struct(F.lit(v).alias("varname"), value_of(df, v).alias("value")) for v in variables])).alias("s")).select("s.*")
    levels: dict[str, list[float]] = {v: [] for v in variables}
    for name, value in found.filter("value is not null").distinct().limit(2 * len(variables) + 1).collect():
        levels[name].append(value)
    sets = []
    for v in variables:
        require(len(levels[v]) == 2, 198, f"{v} does not have exactly two values")
        text = lambda x: str(int(x)) if x.is_integer() else repr(x)
        sets.append([(x, labels[v].get(text(x), text(x))) for x in sorted(levels[v])])
    require(all(s == sets[0] for s in sets), 198, "the variables don't have the same values and labels")
    return sets[0]


def tabulate(
    source: DataFrame | str, variables: str | Sequence[str], *, by: str | None = None, cross: str | None = None, binary: bool = False, stats: Sequence[str] | None = None, types: Sequence[str] | None = None,
    where: str | Column | None = None, window: tuple[int, int] | None = None, order_by: str | None = None, weight: Weight | None = None, nomiss: bool = False, include_missing: bool = False, sort: bool = True, format: str | None = None,
    save: str | None = None, excel: dict | None = None, replace: bool = False,
) -> DataFrame:
    """[by] varname varlab [vallab] proportions, percentages, frequencies, totals.

    ``stats`` (row, col, cell; default col) and ``types`` (prop, pct; default prop) choose among them. With ``by`` there is a table per
    stratum and one of all rows (code -1). With ``cross`` every table has a Total row; levels that a stratum lacks count 0. Missing
    values are left out unless ``include_missing``. ``binary`` puts the two values of each variable side by side.
    """
    df = resolve(source)
    variables = variables.split() if isinstance(variables, str) else list(variables)
    _validate(df, variables, by, cross, stats, types, save, excel, replace)
    stats, types = tuple(stats or ("col",)), tuple(types or ("prop",))
    require(weight is None or weight.kind != "pweight", 198, "pweights are not allowed in tables")
    rows = prepare(df, variables, where, window, order_by, weight, nomiss)
    if by:
        check_total_code(rows, [by])
    labels = value_labels(df, variables)
    pair = check_binary(rows, df, variables, labels) if binary else None
    levels = cross_levels(rows, cross) if cross else []
    counted = _count(df, rows, variables, by, cross, levels, weight, include_missing)
    keys = [*([by] if by else []), "varname"]
    table = _two_way(counted, keys, levels) if cross else _one_way(counted, keys)
    own = {v: (df.schema[v].metadata or {}).get("label") or v for v in variables}
    varlab = F.create_map(*[F.lit(x) for kv in own.items() for x in kv])[F.col("varname")]
    text = F.coalesce(number_text(F.col("value")), F.lit("."))
    table = table.withColumns({"varlab": varlab, "vallab": _label_column(labels, text)})
    if cross and not binary:
        table = table.unionByName(_total_row(table, keys, levels), allowMissingColumns=True)
    table = table.drop("value")
    if pair:
        table = _side_by_side(table, keys, pair)
    named = (df.schema[cross].metadata or {}).get("value_labels", {}) if cross else {}
    out = _pruned(table, by, cross is not None, binary, stats, types, {suffix(v): named.get(str(int(v)), "") for v in levels if v.is_integer()})
    if by:
        out = out.withColumn(by, F.col(by).alias(by, metadata=_group_meta(df, by)))
    if sort:
        freqs = [c for c in out.columns if c.startswith("freq")]
        out = out.orderBy(*[F.col(c).asc_nulls_last() for c in [*keys, *freqs, *(["vallab"] if not binary else [])]])
    if format:
        out = with_formats(out, None if format == "auto" else format)
    if save:
        from ..sources.xlsx import save_tables

        save_tables({(excel or {}).get("sheet", "dtfreq_output"): out}, save, replace=replace)
    return out


def _count(df, rows, variables, by, cross, levels, weight, include_missing) -> DataFrame:
    """[by] varname value, freq (or freq of each level), and the number of rows."""
    whole = weight is None or weight.kind == "fweight"
    long = rows.select(*([by] if by else []), *([value_of(df, cross).alias("_x")] if cross else []), "_w",
                       F.explode(F.array(*[F.struct(F.lit(v).alias("varname"), value_of(df, v).alias("value")) for v in variables])).alias("_s"))
    long = long.select("*", "_s.varname", "_s.value").drop("_s")
    if not include_missing:
        long = long.filter("value is not null")
    if cross:
        long = long.filter("_x is not null")
    # a row counts for itself, so no weight is added up where there is none
    amount = (lambda c: F.sum(F.when(c, F.col("_w")).otherwise(0.0))) if weight else (lambda c: F.count_if(c))
    aggs = [amount(F.col("_x") == v).alias(f"freq{suffix(v)}") for v in levels] if cross else [(F.sum("_w") if weight else F.count("*")).alias("freq")]
    aggs.append(F.count("*").alias("_n"))
    if by:
        sets = [[F.col(by), F.col("varname"), F.col("value")], [F.col("varname"), F.col("value")]]
        counted = long.groupingSets(sets, F.col(by), F.col("varname"), F.col("value")).agg(*aggs, F.grouping(by).alias("_g"))
        counted = counted.filter((F.col("_g") == 1) | F.col(by).isNotNull()).withColumn(by, F.when(F.col("_g") == 1, total_of(df, by)).otherwise(F.col(by))).drop("_g")
    else:
        counted = long.groupBy("varname", "value").agg(*aggs)
    names = [c for c in counted.columns if c.startswith("freq")]
    if weight is not None and weight.kind == "aweight":
        every = Window.partitionBy(*([by] if by else []), "varname")
        sums = sum((F.col(c) for c in names[1:]), F.col(names[0]))
        scale = F.sum("_n").over(every) / F.sum(sums).over(every)
        counted = counted.withColumns({c: F.col(c) * scale for c in names})
    elif whole:
        counted = counted.withColumns({c: F.col(c).cast("long") for c in names})
    return counted.drop("_n")


def _one_way(counted: DataFrame, keys: list[str]) -> DataFrame:
    every = Window.partitionBy(*keys)
    out = counted.withColumn("total", F.sum("freq").over(every)).withColumn("prop", F.try_divide(F.col("freq"), F.col("total")).cast("double"))
    return out.withColumn("pct", F.col("prop") * 100)


def _two_way(counted: DataFrame, keys: list[str], levels: list[float]) -> DataFrame:
    every, ends = Window.partitionBy(*keys), [suffix(v) for v in levels]
    rowfreq = sum((F.col(f"freq{e}") for e in ends[1:]), F.col(f"freq{ends[0]}")) if ends else F.lit(0)
    out = counted.withColumn("rowfreq", rowfreq)
    out = out.withColumns({**{f"total{e}": F.sum(f"freq{e}").over(every) for e in ends}, "total_all": F.sum("rowfreq").over(every)})
    ratio = lambda a, b: F.try_divide(F.col(a), F.col(b)).cast("double")
    made = {}
    for e in ends:
        made |= {f"colprop{e}": ratio(f"freq{e}", f"total{e}"), f"rowprop{e}": ratio(f"freq{e}", "rowfreq"), f"cellprop{e}": ratio(f"freq{e}", "total_all")}
    out = out.withColumns({**made, "prop_all": ratio("rowfreq", "total_all")})
    return out.withColumns({c.replace("prop", "pct"): F.col(c) * 100 for c in [*made, "prop_all"]})


def _total_row(table: DataFrame, keys: list[str], levels: list[float]) -> DataFrame:
    ends = [suffix(v) for v in levels]
    base = table.groupBy(*keys).agg(*[F.first(c).alias(c) for c in [*(f"total{e}" for e in ends), "total_all"]])
    made: dict[str, Column] = {"varlab": F.lit("Grand total"), "vallab": F.lit("Total"), "rowfreq": F.col("total_all"), "prop_all": F.lit(1.0), "pct_all": F.lit(100.0)}
    for e in ends:
        share = F.try_divide(F.col(f"total{e}"), F.col("total_all")).cast("double")
        made |= {f"freq{e}": F.col(f"total{e}"), f"colprop{e}": F.lit(1.0), f"rowprop{e}": share, f"cellprop{e}": share, f"colpct{e}": F.lit(100.0), f"rowpct{e}": share * 100, f"cellpct{e}": share * 100}
    return base.withColumns(made)


def _side_by_side(table: DataFrame, keys: list[str], pair: list[tuple[float, str]]) -> DataFrame:
    """One row per variable, with a column for each measure and value."""
    kept = [c for c in table.columns if c.startswith("total")]
    measures = [c for c in table.columns if c not in {*keys, "varlab", "vallab", *kept}]
    aggs = [F.max(c).alias(c) for c in kept]
    for _, label in pair:
        end = "_" + re.sub(r"\W", "_", label.lower().replace(" ", "_"))
        aggs += [F.max(F.when(F.col("vallab") == label, F.col(c))).alias(c + end) for c in measures]
    return table.groupBy(*keys, "varlab").agg(*aggs)


def _pruned(table: DataFrame, by: str | None, cross: bool, binary: bool, stats: tuple, types: tuple, named: dict[str, str]) -> DataFrame:
    names = [c for c in table.columns if c not in (by, "varname", "varlab", "vallab")]
    if cross:
        names = [c for c in names if not any(c.startswith(s) for s in ("row", "col", "cell") if s not in stats)]
    names = [c for c in names if not any(t in c for t in ("prop", "pct") if t not in types)]
    groups = [[c for c in names if "prop" in c], [c for c in names if "pct" in c], [c for c in names if c.startswith("freq")], [c for c in names if c.startswith("rowfreq")], [c for c in names if c.startswith("total")]]
    ordered = [c for g in groups for c in g]
    return table.select(*([by] if by else []), "varname", "varlab", *([] if binary else ["vallab"]), *[F.col(c).alias(c, metadata={"label": column_label(c, named)}) for c in ordered])


#: What the columns of a table are called.
COLUMN_LABELS = {"freq": "Frequency", "prop": "Proportion", "pct": "Percentage", "colprop": "Column proportion", "rowprop": "Row proportion", "cellprop": "Cell proportion", "colpct": "Column percentage", "rowpct": "Row percentage", "cellpct": "Cell percentage", "rowfreq": "Row total", "total": "Total"}


def column_label(name: str, named: dict[str, str]) -> str:
    """What a column holds, with the label of its cross level if there is one."""
    m = re.match(r"(colprop|rowprop|cellprop|colpct|rowpct|cellpct|rowfreq|freq|prop|pct|total)(.*)", name)
    end = named.get(m[2]) or m[2].strip("_").replace("_", " ")
    return f"{COLUMN_LABELS[m[1]]} {end}".strip()
