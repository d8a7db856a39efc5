"""Registered queries of the engine and, for each that SQL can express, the same in SQL.

Computed doubles are rounded on both sides, as sums run in another order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import filter_rows
from ..functions.labels import clean_label_column
from ..operators import metadata, select
from ..operators.ordering import shared_folder
from ..operators.summary import summarize
from ..operators.tables import tabulate
from ..operators.weights import Weight
from ..sources import parquetio

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
DIGITS = 6
#: Sums have many digits before the point, and fewer after it are the same in any order of adding.
SUM_DIGITS = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame) -> DataFrame:
    digits = lambda name: SUM_DIGITS if name in ("sum", "rawsum") else DIGITS
    return df.select(*[F.round(f.name, digits(f.name)).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name) for f in df.schema])


def query(sql: str | None = None):
    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(f(spark, sf_dir))

        QUERIES[f.__name__] = run
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


# ---- SQL of the same results ----


def _r(expr: str, name: str) -> str:
    return f"round({expr}, {SUM_DIGITS if name.strip('\"') in ('sum', 'rawsum') else DIGITS})::DOUBLE AS {name}"


def _rank(x: str, p: int) -> str:
    n, values = f"(count({x}) * {p})", f"list({x} ORDER BY {x}) FILTER ({x} IS NOT NULL)"
    return f"(CASE WHEN count({x}) = 0 THEN NULL WHEN {n} % 100 = 0 THEN (({values})[{n} // 100] + ({values})[{n} // 100 + 1]) / 2.0 ELSE ({values})[{n} // 100 + 1] END)"


SQL_STATS = {
    "count": lambda x: f"count({x})::BIGINT AS count",
    "mean": lambda x: _r(f"avg({x})", "mean"),
    "median": lambda x: _r(_rank(x, 50), "median"),
    "min": lambda x: _r(f"min({x})", '"min"'),
    "max": lambda x: _r(f"max({x})", '"max"'),
    "sd": lambda x: _r(f"stddev_samp({x})", "sd"),
    "semean": lambda x: _r(f"stddev_samp({x}) / sqrt(count({x}))", "semean"),
    "sebinomial": lambda x: _r(f"CASE WHEN avg({x}) BETWEEN 0 AND 1 THEN sqrt(avg({x}) * (1 - avg({x})) / count({x})) END", "sebinomial"),
    "sepoisson": lambda x: _r(f"CASE WHEN avg({x}) >= 0 THEN sqrt(avg({x}) / count({x})) END", "sepoisson"),
    "sum": lambda x: _r(f"coalesce(sum({x}), 0)", '"sum"'),
    "rawsum": lambda x: _r(f"coalesce(sum({x}), 0)", "rawsum"),
    "iqr": lambda x: _r(f"{_rank(x, 75)} - {_rank(x, 25)}", "iqr"),
}


def stats_sql(source: str, variables: str, stats: str, by: str = "", sets: str = "") -> str:
    keys = by.split()
    parts = []
    for v in variables.split():
        x = f"{v}::DOUBLE"
        cols = [SQL_STATS[s](x) if s in SQL_STATS else _r(_rank(x, int(s[1:])), s) for s in stats.split()]
        group = [f"CASE WHEN grouping({k}) = 1 THEN -1 ELSE {k} END AS {k}" for k in keys]
        keep = " AND ".join(f"(grouping({k}) = 1 OR {k} IS NOT NULL)" for k in keys)
        parts.append(f"SELECT {', '.join([*group, f"'{v}' AS varname", "'' AS varlab", *cols])} FROM {source}" + (f" GROUP BY GROUPING SETS ({sets or f'({', '.join(keys)}), ()'}) HAVING {keep}" if keys else ""))
    return " UNION ALL ".join(parts)


def freq_sql(source: str, variables: str, cols: str, by: str = "", w: str = "1", kind: str = "BIGINT") -> str:
    """One-way tables: columns of the table ``t`` with by, varname, value, freq, total."""
    parts = []
    for v in variables.split():
        keep = f"WHERE {v} IS NOT NULL"
        if by:
            parts.append(f"SELECT CASE WHEN grouping({by}) = 1 THEN -1 ELSE {by} END AS {by}, '{v}' AS varname, {v} AS value, sum({w})::{kind} AS freq FROM {source} {keep} GROUP BY GROUPING SETS (({by}, {v}), ({v})) HAVING grouping({by}) = 1 OR {by} IS NOT NULL")
        else:
            parts.append(f"SELECT '{v}' AS varname, {v} AS value, sum({w})::{kind} AS freq FROM {source} {keep} GROUP BY {v}")
    k = f"{by}, " if by else ""
    return f"WITH t AS (SELECT *, sum(freq) OVER (PARTITION BY {k}varname)::{kind} AS total FROM ({' UNION ALL '.join(parts)})) SELECT {k}varname, varname AS varlab, value::VARCHAR AS vallab, {cols} FROM t"


PROP, PCT = _r("freq / total", "prop"), _r("100 * freq / total", "pct")
JOINED = "(SELECT d.doc_id, n_chars, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
FLAGGED = "(SELECT *, dense_rank() OVER (ORDER BY l_returnflag) AS flag FROM lineitem)"


def documents_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return docs.join(table(spark, sf_dir, "labels"), "doc_id", "left")


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_linenumber", "l_quantity", "l_returnflag", F.col("l_returnflag").alias("flag"))
    return select.encode_categories(items, ["flag"])


# ---- statistics ----


@query(stats_sql("lineitem", "l_quantity l_extendedprice l_discount l_tax", "count mean median min max"))
def stats_default(spark, sf_dir):
    return summarize(table(spark, sf_dir, "lineitem"), "l_quantity l_extendedprice l_discount l_tax", sort=False)


@query(stats_sql("lineitem", "l_quantity l_extendedprice", "count mean min max", "l_linenumber"))
def stats_by_total(spark, sf_dir):
    return summarize(table(spark, sf_dir, "lineitem"), "l_quantity l_extendedprice", by="l_linenumber", stats=["count", "mean", "min", "max"], sort=False)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["stats_by_total"](spark, sf_dir)


@query(stats_sql("(SELECT *, p_partkey % 5 AS part5 FROM part)", "p_retailprice", "count mean median", "p_size part5"))
def stats_multi_by(spark, sf_dir):
    parts = table(spark, sf_dir, "part").withColumn("part5", F.col("p_partkey") % 5)
    return summarize(parts, "p_retailprice", by="p_size part5", stats=["count", "mean", "median"], sort=False)


@query(stats_sql("(SELECT *, p_partkey % 5 AS part5 FROM part)", "p_retailprice", "count mean median", "p_size part5", "(p_size, part5), (p_size), ()"))
def stats_subtotals(spark, sf_dir):
    parts = table(spark, sf_dir, "part").withColumn("part5", F.col("p_partkey") % 5)
    return summarize(parts, "p_retailprice", by="p_size part5", stats=["count", "mean", "median"], subtotals=True, sort=False)


@query(stats_sql("orders", "o_totalprice", "count sd semean sepoisson iqr min max"))
def stats_dispersion(spark, sf_dir):
    return summarize(table(spark, sf_dir, "orders"), "o_totalprice", stats=["count", "sd", "semean", "sepoisson", "iqr", "min", "max"], sort=False)


@query(stats_sql("labels", "quality toxic", "count mean sebinomial sepoisson"))
def stats_standard_errors(spark, sf_dir):
    return summarize(table(spark, sf_dir, "labels"), "quality toxic", stats=["count", "mean", "sebinomial", "sepoisson"], sort=False)


@query(stats_sql("lineitem", "l_quantity l_extendedprice", "p1 p5 p10 p25 p50 p75 p90 p95 p99", "l_linenumber"))
def stats_percentiles(spark, sf_dir):
    return summarize(table(spark, sf_dir, "lineitem"), "l_quantity l_extendedprice", by="l_linenumber", stats=["p1", "p5", "p10", "p25", "p50", "p75", "p90", "p95", "p99"], sort=False)


@query(stats_sql("part", "p_retailprice p_size", "iqr median", "p_size"))
def stats_iqr(spark, sf_dir):
    return summarize(table(spark, sf_dir, "part"), "p_retailprice p_size", by="p_size", stats=["iqr", "median"], sort=False)


@query(stats_sql("customer", "c_acctbal", "count mean min max sum"))
def stats_negative(spark, sf_dir):
    return summarize(table(spark, sf_dir, "customer"), "c_acctbal", stats=["count", "mean", "min", "max", "sum"], sort=False)


_WEIGHTED = "SELECT l_extendedprice AS x, l_linenumber::DOUBLE AS w, l_linenumber % 3 AS g FROM lineitem"
_CENTRED = f"SELECT *, sum(w * x) OVER (PARTITION BY g) / sum(w) OVER (PARTITION BY g) AS m FROM ({_WEIGHTED} UNION ALL SELECT x, w, -1 AS g FROM ({_WEIGHTED}))"
_MOMENTS = f"sum(w) AS sw, sum(w * x) AS swx, sum(w * (x - m) * (x - m)) AS spread, count(x) AS n, sum(x) AS raw FROM ({_CENTRED}) GROUP BY g"


def weighted_sql(count: str, total: str, sd: str | None) -> str:
    return f"SELECT g, 'l_extendedprice' AS varname, '' AS varlab, {count} AS count, {_r('swx / sw', 'mean')}, {_r(total, '"sum"')}, {_r('raw', 'rawsum')}{', ' + _r(f'sqrt({sd})', 'sd') if sd else ''} FROM (SELECT g, {_MOMENTS})"


def weighted_stats(spark, sf_dir, kind: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").withColumn("g", F.col("l_linenumber") % 3)
    stats = ["count", "mean", "sum", "rawsum", *(["sd"] if kind != "pweight" else [])]
    return summarize(items, "l_extendedprice", by="g", weight=Weight(kind, "l_linenumber"), stats=stats, sort=False)


@query(weighted_sql("sw::BIGINT", "swx", "spread / (sw - 1)"))
def stats_weighted_f(spark, sf_dir):
    return weighted_stats(spark, sf_dir, "fweight")


@query(weighted_sql("n::BIGINT", "swx * n / sw", "spread * n / sw / (n - 1)"))
def stats_weighted_a(spark, sf_dir):
    return weighted_stats(spark, sf_dir, "aweight")


@query(weighted_sql("sw", "swx", "spread / (sw - 1)"))
def stats_weighted_i(spark, sf_dir):
    return weighted_stats(spark, sf_dir, "iweight")


@query(weighted_sql("sw", "swx", None))
def stats_weighted_p(spark, sf_dir):
    return weighted_stats(spark, sf_dir, "pweight")


@query(f"""
WITH s AS (SELECT l_linenumber AS g, l_quantity AS x, l_tax * 100 + 1 AS w FROM lineitem UNION ALL SELECT -1, l_quantity, l_tax * 100 + 1 FROM lineitem),
d AS (SELECT g, x, sum(round(w)::BIGINT) AS w FROM s GROUP BY g, x),
c AS (SELECT g, x, w, sum(w) OVER (PARTITION BY g ORDER BY x) AS cw, sum(w) OVER (PARTITION BY g) AS tw FROM d)
SELECT g AS l_linenumber, 'l_quantity' AS varname, '' AS varlab, {', '.join(f"round(avg(CASE WHEN (cw * 100 > tw * {p} AND (cw - w) * 100 <= tw * {p}) OR cw * 100 = tw * {p} THEN x END), 6)::DOUBLE AS p{p}" for p in (10, 25, 75))} FROM c GROUP BY g
""")
def stats_weighted_percentile(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").withColumn("w", F.round(F.col("l_tax") * 100 + 1))
    return summarize(items, "l_quantity", by="l_linenumber", weight=Weight("fweight", "w"), stats=["p10", "p25", "p75"], sort=False)


@query(f"""SELECT g, 'o_totalprice' AS varname, '' AS varlab, {_r('coalesce(sum(x), 0)', 'rawsum')}, {_r('100.0 * count(x) / max(n)', '"percent"')} FROM
(SELECT o_custkey % 4 AS g, o_totalprice AS x, count(o_totalprice) OVER () AS n FROM orders UNION ALL SELECT -1, o_totalprice, count(o_totalprice) OVER () FROM orders) GROUP BY g""")
def stats_rawsum_percent(spark, sf_dir):
    return summarize(table(spark, sf_dir, "orders").withColumn("g", F.col("o_custkey") % 4), "o_totalprice", by="g", stats=["rawsum", "percent"], sort=False)


@query("""SELECT g, 'y' AS varname, '' AS varlab, round(arg_min_null(y, event_id), 6)::DOUBLE AS "first", round(arg_max_null(y, event_id), 6)::DOUBLE AS "last", round(arg_min(y, event_id), 6)::DOUBLE AS firstnm, round(arg_max(y, event_id), 6)::DOUBLE AS lastnm FROM
(SELECT event_id, user_id % 3 AS g, CASE WHEN event_id % 4 <> 0 THEN value END AS y FROM events UNION ALL SELECT event_id, -1, CASE WHEN event_id % 4 <> 0 THEN value END FROM events) GROUP BY g""")
def stats_first_last(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumns({"g": F.col("user_id") % 3, "y": F.when(F.col("event_id") % 4 != 0, F.col("value"))})
    return summarize(events, "y", by="g", stats=["first", "last", "firstnm", "lastnm"], order_by="event_id", sort=False)


@query(stats_sql("(SELECT * FROM (SELECT *, row_number() OVER (ORDER BY event_id) AS i FROM events) WHERE i BETWEEN 101 AND 5000 AND value > 10)", "value", "count mean median min max"))
def stats_if_in(spark, sf_dir):
    return summarize(table(spark, sf_dir, "events"), "value", where="value > 10", window=(101, 5000), order_by="event_id", sort=False)


@query(stats_sql(JOINED, "n_chars", "count mean median min max", "quality"))
def stats_missing_by(spark, sf_dir):
    return summarize(documents_labels(spark, sf_dir), "n_chars", by="quality", sort=False)


@query(stats_sql(f"{JOINED[:-1]} WHERE quality IS NOT NULL AND toxic IS NOT NULL)", "n_chars quality toxic", "count mean median min max"))
def stats_nomiss(spark, sf_dir):
    return summarize(documents_labels(spark, sf_dir), "n_chars quality toxic", nomiss=True, sort=False)


@query(stats_sql("lineitem", "l_extendedprice", "median p90", "l_linenumber"))
def stats_fast_weighted(spark, sf_dir):
    """With weights (of 1 here) the fast way gives exact ranks."""
    items = table(spark, sf_dir, "lineitem").withColumn("one", F.lit(1))
    return summarize(items, "l_extendedprice", by="l_linenumber", stats=["median", "p90"], fast=True, weight=Weight("fweight", "one"), sort=False)


@query("SELECT 'x' AS varname, '' AS varlab, round(sqrt(sum(w * (x - m) * (x - m)) / (sum(w) - 1)), 3)::DOUBLE AS sd FROM (SELECT l_linenumber AS x, l_quantity AS w, sum(l_quantity * l_linenumber) OVER () / sum(l_quantity) OVER () AS m FROM lineitem)")
def stats_weighted_far(spark, sf_dir):
    """The spread of values that all lie far from 0 is that of the same values near it."""
    items = table(spark, sf_dir, "lineitem").withColumn("x", F.col("l_linenumber") + F.lit(1e9))
    return summarize(items, "x", stats=["sd"], weight=Weight("fweight", "l_quantity"), sort=False).withColumn("sd", F.round("sd", 3))


@query()
def stats_fast(spark, sf_dir):
    return summarize(table(spark, sf_dir, "lineitem"), "l_extendedprice", by="l_linenumber", fast=True, sort=False)


# ---- frequency tables ----


@query(freq_sql("lineitem", "l_linenumber", f"{PROP}, freq, total"))
def freq_oneway(spark, sf_dir):
    return tabulate(table(spark, sf_dir, "lineitem"), "l_linenumber", sort=False)


@query(freq_sql("labels", "quality toxic", f"{PROP}, freq, total"))
def freq_multi_var(spark, sf_dir):
    return tabulate(table(spark, sf_dir, "labels"), "quality toxic", sort=False)


@query(freq_sql("lineitem", "l_linenumber", f"{PCT}, freq, total"))
def freq_pct(spark, sf_dir):
    return tabulate(table(spark, sf_dir, "lineitem"), "l_linenumber", types=["pct"], sort=False)


@query(freq_sql("part", "p_size", f"{PROP}, {PCT}, freq, total"))
def freq_types(spark, sf_dir):
    return tabulate(table(spark, sf_dir, "part"), "p_size", types=["prop", "pct"], sort=False)


@query(freq_sql("labels", "quality", f"{PROP}, freq, total", by="toxic"))
def freq_by(spark, sf_dir):
    return tabulate(table(spark, sf_dir, "labels"), "quality", by="toxic", sort=False)


@query(freq_sql(JOINED, "toxic", f"{PROP}, freq, total", by="quality"))
def freq_missing(spark, sf_dir):
    return tabulate(documents_labels(spark, sf_dir), "toxic", by="quality", sort=False)


@query(freq_sql(f"{JOINED[:-1]} WHERE quality IS NOT NULL AND toxic IS NOT NULL)", "quality toxic", f"{PROP}, freq, total"))
def freq_nomiss(spark, sf_dir):
    return tabulate(documents_labels(spark, sf_dir), "quality toxic", nomiss=True, sort=False)


@query(f"""WITH t AS (SELECT quality AS value, count(*) AS freq FROM {JOINED} GROUP BY 1)
SELECT 'quality' AS varname, 'quality' AS varlab, coalesce(value::VARCHAR, '.') AS vallab, round(freq / sum(freq) OVER (), 6)::DOUBLE AS prop, freq::BIGINT AS freq, (sum(freq) OVER ())::BIGINT AS total FROM t""")
def freq_include_missing(spark, sf_dir):
    return tabulate(documents_labels(spark, sf_dir), "quality", include_missing=True, sort=False)


@query(freq_sql("lineitem", "l_linenumber", f"{PROP}, freq, total", w="l_quantity"))
def freq_weighted_f(spark, sf_dir):
    return tabulate(table(spark, sf_dir, "lineitem"), "l_linenumber", weight=Weight("fweight", "l_quantity"), sort=False)


@query(f"SELECT 'l_linenumber' AS varname, 'l_linenumber' AS varlab, v::VARCHAR AS vallab, {_r('w / tw', 'prop')}, {_r('w * n / tw', 'freq')}, {_r('n', 'total')} FROM (SELECT l_linenumber AS v, sum(l_quantity) AS w, sum(sum(l_quantity)) OVER () AS tw, sum(count(*)) OVER () AS n FROM lineitem GROUP BY 1)")
def freq_weighted_a(spark, sf_dir):
    return tabulate(table(spark, sf_dir, "lineitem"), "l_linenumber", weight=Weight("aweight", "l_quantity"), sort=False)


def cross_sql(source: str, v: str, cross: str, levels: tuple, stats: tuple, types: tuple = ("prop",), by: str = "") -> str:
    """Two-way table with Total rows."""
    k = f"{by}, " if by else ""
    count = ", ".join(f"count(*) FILTER ({cross} = {c}) AS freq{c}" for c in levels)
    if by:
        base = f"SELECT CASE WHEN grouping({by}) = 1 THEN -1 ELSE {by} END AS {by}, {v} AS value, {count} FROM {source} WHERE {v} IS NOT NULL AND {cross} IS NOT NULL GROUP BY GROUPING SETS (({by}, {v}), ({v})) HAVING grouping({by}) = 1 OR {by} IS NOT NULL"
    else:
        base = f"SELECT {v} AS value, {count} FROM {source} WHERE {v} IS NOT NULL AND {cross} IS NOT NULL GROUP BY {v}"
    part = f"PARTITION BY {by}" if by else ""
    over = ", ".join(f"(sum(freq{c}) OVER ({part}))::BIGINT AS total{c}" for c in levels)
    rows = " + ".join(f"freq{c}" for c in levels)
    made, total = [], []
    for t in types:
        m = 100 if t == "pct" else 1
        for c in levels:
            if "col" in stats:
                made.append(_r(f"{m} * freq{c} / nullif(total{c}, 0)", f"col{t}{c}"))
                total.append(f"{m}.0::DOUBLE AS col{t}{c}")
            if "row" in stats:
                made.append(_r(f"{m} * freq{c} / rowfreq", f"row{t}{c}"))
                total.append(_r(f"{m} * any_value(total{c}) / any_value(total_all)", f"row{t}{c}"))
            if "cell" in stats:
                made.append(_r(f"{m} * freq{c} / total_all", f"cell{t}{c}"))
                total.append(_r(f"{m} * any_value(total{c}) / any_value(total_all)", f"cell{t}{c}"))
        made.append(_r(f"{m} * rowfreq / total_all", f"{t}_all"))
        total.append(f"{m}.0::DOUBLE AS {t}_all")
    made += [f"freq{c}::BIGINT AS freq{c}" for c in levels]
    total += [f"any_value(total{c}) AS freq{c}" for c in levels]
    if "row" in stats:
        made.append("rowfreq::BIGINT AS rowfreq")
        total.append("any_value(total_all) AS rowfreq")
    made += [*(f"total{c}" for c in levels), "total_all"]
    total += [*(f"any_value(total{c}) AS total{c}" for c in levels), "any_value(total_all) AS total_all"]
    return (f"WITH b AS ({base}), r AS (SELECT *, {rows} AS rowfreq FROM b), t AS (SELECT *, {over}, (sum(rowfreq) OVER ({part}))::BIGINT AS total_all FROM r) "
            f"SELECT {k}'{v}' AS varname, '{v}' AS varlab, value::VARCHAR AS vallab, {', '.join(made)} FROM t UNION ALL SELECT {k}'{v}', 'Grand total', 'Total', {', '.join(total)} FROM t" + (f" GROUP BY {by}" if by else ""))


@query(cross_sql(FLAGGED, "l_linenumber", "flag", (1, 2, 3), ("col",)))
def freq_cross_col(spark, sf_dir):
    return tabulate(flagged(spark, sf_dir), "l_linenumber", cross="flag", sort=False)


@query(cross_sql(FLAGGED, "l_linenumber", "flag", (1, 2, 3), ("row",)))
def freq_cross_row(spark, sf_dir):
    return tabulate(flagged(spark, sf_dir), "l_linenumber", cross="flag", stats=["row"], sort=False)


@query(cross_sql(FLAGGED, "l_linenumber", "flag", (1, 2, 3), ("cell",), ("pct",)))
def freq_cross_cell(spark, sf_dir):
    return tabulate(flagged(spark, sf_dir), "l_linenumber", cross="flag", stats=["cell"], types=["pct"], sort=False)


@query(cross_sql(FLAGGED, "l_linenumber", "flag", (1, 2, 3), ("row", "col", "cell"), ("prop", "pct")))
def freq_cross_total(spark, sf_dir):
    return tabulate(flagged(spark, sf_dir), "l_linenumber", cross="flag", stats=["row", "col", "cell"], types=["prop", "pct"], sort=False)


@query(cross_sql("(SELECT *, o_orderkey % 3 AS third, o_custkey % 2 AS odd, o_custkey % 5 AS fifth FROM orders)", "third", "odd", (0, 1), ("col", "cell"), by="fifth"))
def freq_by_cross(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumns({"third": F.col("o_orderkey") % 3, "odd": F.col("o_custkey") % 2, "fifth": F.col("o_custkey") % 5})
    return tabulate(orders, "third", cross="odd", by="fifth", stats=["col", "cell"], sort=False)


@query(" UNION ALL ".join(f"SELECT '{v}' AS varname, '{v}' AS varlab, {_r(f'avg(1 - {v})', 'prop_0')}, {_r(f'avg({v})', 'prop_1')}, sum(1 - {v})::BIGINT AS freq_0, sum({v})::BIGINT AS freq_1, count(*)::BIGINT AS total FROM labels" for v in ("quality", "toxic")))
def freq_binary(spark, sf_dir):
    return tabulate(table(spark, sf_dir, "labels"), "quality toxic", binary=True, sort=False)


@query(f"""SELECT 'quality' AS varname, 'quality' AS varlab, {', '.join(_r(f"count(*) FILTER (toxic = {c} AND quality = {q}) / count(*) FILTER (toxic = {c})", f"colprop{c}_{n}") for q, n in ((0, "bad"), (1, "good")) for c in (0, 1))},
{', '.join(_r(f"count(*) FILTER (quality = {q}) / count(*)", f"prop_all_{n}") for q, n in ((0, "bad"), (1, "good")))},
{', '.join(f"count(*) FILTER (toxic = {c} AND quality = {q}) AS freq{c}_{n}" for q, n in ((0, "bad"), (1, "good")) for c in (0, 1))},
{', '.join(f"count(*) FILTER (toxic = {c}) AS total{c}" for c in (0, 1))}, count(*) AS total_all FROM labels""")
def freq_binary_cross(spark, sf_dir):
    labels = metadata.annotate(table(spark, sf_dir, "labels"), "quality", value_labels={0: "Bad", 1: "Good"})
    return tabulate(labels, "quality", cross="toxic", binary=True, sort=False)


# ---- choosing rows and columns ----


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 100000 AND o_orderkey <> 5")
def filter_cmp(spark, sf_dir):
    return filter_rows(table(spark, sf_dir, "orders"), "o_totalprice >= 100000 & o_orderkey != 5").select("o_orderkey", "o_totalprice")


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE NOT (l_quantity > 10 AND l_linenumber < 3) OR l_returnflag = 'A'")
def filter_bool(spark, sf_dir):
    return filter_rows(table(spark, sf_dir, "lineitem"), '!(l_quantity > 10 & l_linenumber < 3) | l_returnflag == "A"').select("l_orderkey", "l_linenumber", "l_quantity")


@query("SELECT event_id, value FROM events WHERE value BETWEEN 5 AND 25")
def filter_inrange(spark, sf_dir):
    return filter_rows(table(spark, sf_dir, "events"), "inrange(value, 5, 25)").select("event_id", "value")


@query("SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag IN ('A', 'N') AND l_linenumber IN (1, 3, 5)")
def filter_inlist(spark, sf_dir):
    return filter_rows(table(spark, sf_dir, "lineitem"), "inlist(l_returnflag, 'A', 'N') & inlist(l_linenumber, 1, 3, 5)").select("l_orderkey", "l_linenumber", "l_returnflag")


@query(f"SELECT doc_id, n_chars FROM {JOINED} WHERE quality IS NULL AND NOT (n_chars IS NULL)")
def filter_missing(spark, sf_dir):
    return filter_rows(documents_labels(spark, sf_dir), "missing(quality) & !missing(n_chars)").select("doc_id", "n_chars")


@query("SELECT c_custkey, c_name FROM customer WHERE try_cast(substring(c_name, 10) AS DOUBLE) > 100 OR c_nationkey::VARCHAR = '7'")
def filter_cast(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").withColumn("tail", F.substring("c_name", 10, 99))
    return filter_rows(customers, "real(tail) > 100 | string(c_nationkey) == '7'").select("c_custkey", "c_name")


@query("SELECT event_id, value FROM events WHERE event_id % 7 = 3 AND floor(value) >= 2")
def filter_extensions(spark, sf_dir):
    return filter_rows(table(spark, sf_dir, "events"), "mod(event_id, 7) == 3 & floor(value) >= 2", extensions=True).select("event_id", "value")


@query("SELECT o_orderdate, o_custkey, o_totalprice FROM orders")
def project_wildcard(spark, sf_dir):
    return select.project(table(spark, sf_dir, "orders"), "o_*date o_?ustkey o_total*")


@query("SELECT o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS i FROM orders) WHERE i BETWEEN 11 AND 500 AND o_totalprice > 1000")
def row_window(spark, sf_dir):
    rows = select.row_window(table(spark, sf_dir, "orders"), 11, 500, "o_orderkey")
    return filter_rows(rows, "o_totalprice > 1000").select("o_orderkey", "o_totalprice")


@query("SELECT n_nationkey, n_name FROM nation WHERE n_nationkey BETWEEN 5 AND 14 AND n_regionkey <> 1")
def read_window(spark, sf_dir):
    """The nations lie in the file in the order of their keys."""
    return parquetio.read(spark, f"{sf_dir}/nation.parquet", "n_nationkey n_name", "n_regionkey != 1", (6, 15))


@query("SELECT c_custkey, row_number() OVER (ORDER BY c_nationkey, c_acctbal DESC, c_custkey) AS position FROM customer")
def sort_multi(spark, sf_dir):
    """All rows, with their places in the order."""
    return select.number_sorted(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal"), "c_nationkey -c_acctbal c_custkey").select("c_custkey", "position")


@query("SELECT o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS i FROM orders) WHERE i BETWEEN 200 AND 12000")
def row_window_far(spark, sf_dir):
    """A window beyond what a limit of the sorted rows serves."""
    return select.row_window(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), 200, 12_000, ["o_totalprice", "o_orderkey"])


@query("SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey::INTEGER AS o_custkey, round(o_totalprice::FLOAT::DOUBLE, 6) AS price, o_orderstatus FROM orders")
def cast_plan(spark, sf_dir):
    cast = select.cast_columns(table(spark, sf_dir, "orders"), '{"string": ["o_orderkey"], "int32": ["o_custkey", "nothing"], "float32": ["o_totalprice"], "odd": ["o_orderkey"]}')
    return cast.select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("double").alias("price"), "o_orderstatus")


@query("SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey, o_totalprice, o_orderstatus FROM orders")
def allstring(spark, sf_dir):
    return parquetio.read(spark, f"{sf_dir}/orders.parquet", "o_orderkey o_custkey o_totalprice o_orderstatus", allstring=True)


@query("SELECT c_custkey, dense_rank() OVER (ORDER BY c_mktsegment)::INTEGER AS c_mktsegment FROM customer")
def cat_encode(spark, sf_dir):
    return parquetio.read(spark, f"{sf_dir}/customer.parquet", "c_custkey c_mktsegment", catmode="encode", categories=["c_mktsegment"])


@query("SELECT c_custkey, c_mktsegment, dense_rank() OVER (ORDER BY c_mktsegment)::INTEGER AS c_mktsegment_id FROM customer")
def cat_both(spark, sf_dir):
    return parquetio.read(spark, f"{sf_dir}/customer.parquet", "c_custkey c_mktsegment", catmode="both", categories=["c_mktsegment"])


@query()
def sample(spark, sf_dir):
    return select.sample_rows(table(spark, sf_dir, "events").select("event_id"), 0.1, seed=7)


# ---- files ----


@query("SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem")
def partition_roundtrip(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    path = parquetio.write(items, f"{shared_folder(spark)}/parts", partition_by="l_returnflag")
    return parquetio.read(spark, path).select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")


@query("SELECT codec, o_orderkey, o_totalprice FROM orders, (SELECT unnest(['archive', 'balanced', 'fast', 'gzip', 'snappy', 'uncompressed']) AS codec)")
def codec_roundtrip(spark, sf_dir):
    orders, base, out = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), shared_folder(spark), None
    for codec in ("archive", "balanced", "fast", "gzip", "snappy", "uncompressed"):
        back = parquetio.read(spark, parquetio.write(orders, f"{base}/{codec}", compress=codec)).select(F.lit(codec).alias("codec"), "o_orderkey", "o_totalprice")
        out = back if out is None else out.unionByName(back)
    return out


@query("SELECT n_nationkey, (n_nationkey % 3)::BIGINT AS part FROM nation")
def glob_filename(spark, sf_dir):
    nations, base = table(spark, sf_dir, "nation"), shared_folder(spark)
    for k in range(3):
        nations.filter(F.col("n_nationkey") % 3 == k).select("n_nationkey").write.parquet(f"{base}/n-{k}.parquet")
    return parquetio.read(spark, f"{base}/n-*.parquet", "n_nationkey", filename="part")


@query("SELECT s_suppkey, s_acctbal FROM supplier WHERE s_acctbal < 0")
def filtered_save(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    return parquetio.read(spark, parquetio.write(suppliers, f"{shared_folder(spark)}/below", where="s_acctbal < 0"))


@query("SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def single_file(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    return parquetio.read(spark, parquetio.write(orders, f"{shared_folder(spark)}/orders", single=True))


@query("SELECT c_custkey::DOUBLE AS key, c_acctbal AS amount, NULL::VARCHAR AS name FROM customer UNION ALL SELECT s_suppkey::DOUBLE + 0.5::DOUBLE, s_acctbal, s_name FROM supplier")
def widened_files(spark, sf_dir):
    base = shared_folder(spark)
    table(spark, sf_dir, "customer").selectExpr("c_custkey AS key", "c_acctbal AS amount").write.parquet(f"{base}/w-1.parquet")
    table(spark, sf_dir, "supplier").selectExpr("s_suppkey + 0.5D AS key", "s_acctbal AS amount", "s_name AS name").write.parquet(f"{base}/w-2.parquet")
    return parquetio.read(spark, f"{base}/w-*.parquet")


@query("SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem")
def folder_scan(spark, sf_dir):
    items, base = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate"), shared_folder(spark)
    for k in range(2):
        items.filter(F.col("l_linenumber") % 2 == k).write.parquet(f"{base}/all/part{k}")
    return parquetio.read(spark, f"{base}/all", recursive=True)


@query("SELECT * FROM (VALUES ('n_nationkey', 'long', '%12.0f', '', ''), ('n_name', 'string', '%9s', '', ''), ('n_regionkey', 'long', '%12.0f', '', '')) AS t(varname, vartype, format, vallab, varlab)")
def describe_schema(spark, sf_dir):
    return parquetio.describe(spark, f"{sf_dir}/nation.parquet")[1]


@query("SELECT 'c_name' AS varname, 'str' || max(strlen(c_name)) AS vartype, '%' || greatest(9, max(strlen(c_name))) || 's' AS format, '' AS vallab, '' AS varlab FROM customer")
def describe_detailed(spark, sf_dir):
    return parquetio.describe(spark, f"{sf_dir}/customer.parquet", detailed=True)[1].filter("varname = 'c_name'")


# ---- metadata ----


def _labelled(spark, sf_dir) -> DataFrame:
    labels = metadata.annotate(table(spark, sf_dir, "labels"), "quality", label="A1. Quality", value_labels={0: "Bad", 1: "Good"}, notes=["by hand", "twice"])
    return metadata.annotate(labels, "toxic", value_label="quality", value_labels={0: "Bad", 1: "Good"})


@query("SELECT * FROM (VALUES ('variable', 1, 'doc_id', 'double', '%12.2f', '', ''), ('variable', 2, 'quality', 'long', '%12.0f', 'quality', 'A1. Quality'), ('variable', 3, 'toxic', 'long', '%12.0f', 'quality', '')) AS t(_level, position, varname, type, format, vallab, varlab)")
def meta_vars(spark, sf_dir):
    return metadata.describe_metadata(_labelled(spark, sf_dir))["_dtvars"]


@query("SELECT * FROM (VALUES ('value label', 'quality toxic', 1, 'quality', 0::BIGINT, 'Bad', 0), ('value label', 'quality toxic', 2, 'quality', 1::BIGINT, 'Good', 0)) AS t(_level, varname, index, vallab, value, label, trunc)")
def meta_labels(spark, sf_dir):
    return metadata.describe_metadata(_labelled(spark, sf_dir))["_dtlabel"]


@query("SELECT * FROM (VALUES ('variable', 'quality', 1, 'by hand'), ('variable', 'quality', 2, 'twice')) AS t(_level, varname, _note_id, _note_text)")
def meta_notes(spark, sf_dir):
    return metadata.describe_metadata(_labelled(spark, sf_dir))["_dtnotes"]


@query("SELECT 'dataset' AS _level, count(*) AS dta_obs, 5 AS dta_vars, 'Customers' AS dta_label, 1 AS _note_id, 'a note' AS _note_text FROM customer")
def meta_info(spark, sf_dir):
    return metadata.describe_metadata(table(spark, sf_dir, "customer"), label="Customers", notes=["a note"])["_dtinfo"].drop("dta_ts")


@query("SELECT n_nationkey, CASE n_regionkey WHEN 0 THEN 'zero' WHEN 1 THEN 'one' ELSE n_regionkey::VARCHAR END AS region FROM nation")
def label_decode(spark, sf_dir):
    return select.decode_labels(table(spark, sf_dir, "nation"), "n_regionkey", {0: "zero", 1: "one"}, "region").select("n_nationkey", "region")


@query("SELECT n_nationkey, CASE WHEN contains(l, '.') THEN substring(l, instr(l, '.') + 2) ELSE l END AS label FROM (SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN 'A' || n_nationkey || '. ' || n_name ELSE n_name END AS l FROM nation)")
def varlab_clean(spark, sf_dir):
    label = F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("A"), F.col("n_nationkey").cast("string"), F.lit(". "), F.col("n_name"))).otherwise(F.col("n_name"))
    return table(spark, sf_dir, "nation").select("n_nationkey", clean_label_column(label).alias("label"))


# ---- relational helpers ----


@query("SELECT k, name, extra FROM (SELECT n_nationkey::BIGINT AS k, n_name AS name, NULL::DOUBLE AS extra FROM nation UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier)")
def union_append(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("extra"))
    return select.append_rows(nations, suppliers).select("k", "name", "extra")


@query("SELECT s_nationkey, s_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS i FROM supplier) WHERE i = 1")
def dedup_first(spark, sf_dir):
    return select.first_of_each(table(spark, sf_dir, "supplier"), ["s_nationkey"], ["s_suppkey"]).select("s_nationkey", "s_suppkey")


@query('SELECT s_suppkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey)::INTEGER AS "index" FROM supplier')
def row_number(spark, sf_dir):
    return select.number_rows(table(spark, sf_dir, "supplier"), ["s_nationkey"], ["s_suppkey"]).select("s_suppkey", "index")


@query('SELECT c_custkey, dense_rank() OVER (ORDER BY c_mktsegment, c_nationkey)::INTEGER AS "group" FROM customer')
def group_number(spark, sf_dir):
    return select.group_number(table(spark, sf_dir, "customer"), ["c_mktsegment", "c_nationkey"]).select("c_custkey", "group")


@query(f"SELECT s_suppkey, {_r('sum(s_acctbal) OVER (PARTITION BY s_nationkey)', 'total')} FROM supplier")
def group_total(spark, sf_dir):
    return select.group_value(table(spark, sf_dir, "supplier"), ["s_nationkey"], "s_acctbal", "sum", "total").select("s_suppkey", "total")


@query("SELECT r_regionkey, copy::INTEGER AS copy FROM region, (SELECT unnest([0, 1]) AS copy)")
def expand_total(spark, sf_dir):
    return select.expand_rows(table(spark, sf_dir, "region"), 2).select("r_regionkey", "copy")


@query("SELECT DISTINCT p_size, p_brand FROM part WHERE p_size IS NOT NULL AND p_brand IS NOT NULL")
def distinct_levels(spark, sf_dir):
    return select.cross_levels(table(spark, sf_dir, "part"), ["p_size", "p_brand"])


@query("SELECT s_suppkey, max(s_acctbal) OVER (PARTITION BY s_nationkey) AS top FROM supplier")
def group_max(spark, sf_dir):
    return select.group_value(table(spark, sf_dir, "supplier"), ["s_nationkey"], "s_acctbal", "max", "top").select("s_suppkey", "top")


@query("SELECT n_regionkey, max(CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey END) AS key0, max(CASE WHEN n_nationkey % 2 = 1 THEN n_nationkey END) AS key1 FROM nation GROUP BY 1")
def reshape_wide(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").withColumn("odd", F.col("n_nationkey") % 2)
    return select.reshape_wide(nations, ["n_regionkey"], "odd", [0, 1], "n_nationkey", "key")
