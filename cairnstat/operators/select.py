"""Choosing columns and rows: wildcards, row windows, samples, casts, categories."""

from __future__ import annotations

import json
from fnmatch import fnmatchcase

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import EngineError, require
from .ordering import number_in_order

#: Up to here a row window is a limit of the sorted rows; rows further on are numbered first.
NEAR = 10_000

CASTS = {"boolean": "boolean", "int8": "tinyint", "int16": "smallint", "int32": "int", "int64": "bigint", "uint8": "smallint", "uint16": "int", "uint32": "bigint", "uint64": "decimal(20,0)", "float32": "float", "float64": "double", "string": "string"}


def match_columns(columns: list[str], patterns: str | list[str]) -> list[str]:
    """Names that the patterns (``*`` and ``?``) match, in the order asked for, each once."""
    found: dict[str, None] = {}
    for pattern in patterns.split() if isinstance(patterns, str) else patterns:
        hits = [c for c in columns if c == pattern] or [c for c in columns if fnmatchcase(c, pattern)]
        require(bool(hits), 111, f"variable {pattern} not found")
        found.update(dict.fromkeys(hits))
    return list(found)


def project(df: DataFrame, patterns: str | list[str] | None) -> DataFrame:
    return df if not patterns else df.select(*match_columns(df.columns, patterns))


def row_window(df: DataFrame, first: int, last: int, order_by: str | list[str]) -> DataFrame:
    """Rows ``first`` to ``last`` (from 1, both included) in the given order. A filter on the result comes after the window."""
    require(first >= 1, 198, "the window starts at 1")
    order = [F.col(c).asc_nulls_last() for c in ([order_by] if isinstance(order_by, str) else order_by)]
    if last <= NEAR:
        return df.orderBy(*order).offset(first - 1).limit(max(0, last - first + 1))
    return number_in_order(df, order, "_row").filter(F.col("_row").between(first, last)).drop("_row")


def sort_rows(df: DataFrame, keys: str | list[str]) -> DataFrame:
    """``-name`` sorts downwards; nulls come first upwards and last downwards."""
    keys = keys.split() if isinstance(keys, str) else keys
    return df.orderBy(*[F.col(k[1:]).desc_nulls_last() if k.startswith("-") else F.col(k).asc_nulls_first() for k in keys])


def number_sorted(df: DataFrame, keys: str | list[str], name: str = "position") -> DataFrame:
    """Each row's number from 1 in the order of ``sort_rows``."""
    keys = keys.split() if isinstance(keys, str) else keys
    return number_in_order(df, [F.col(k[1:]).desc_nulls_last() if k.startswith("-") else F.col(k).asc_nulls_first() for k in keys], name)


def cross_levels(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct combinations of the columns that occur, without those that have a null."""
    return df.select(*columns).dropna().distinct()


def reshape_wide(df: DataFrame, keys: list[str], column: str, levels: list, value: str, prefix: str) -> DataFrame:
    """A row per key with a column ``<prefix><level>`` for each level; the largest value where there are several."""
    wide = df.groupBy(*keys).pivot(column, levels).agg(F.max(value))
    return wide.withColumnsRenamed({str(k): f"{prefix}{k}" for k in levels})


def sample_rows(df: DataFrame, share: float, seed: int = 0) -> DataFrame:
    """A share of the rows without replacement; seed 0 draws anew each time."""
    require(0 <= share <= 1, 198, "the share is between 0 and 1")
    return df.sample(False, share, seed) if seed else df.sample(False, share)


def sample_exact(df: DataFrame, n: int, key: str, seed: int) -> DataFrame:
    """``n`` rows by the order of a seeded hash of ``key``: the same rows each time."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), F.col(key)).limit(n)


def cast_columns(df: DataFrame, plan: str | dict[str, list[str]]) -> DataFrame:
    """Casts by ``{type: [columns]}`` (or its JSON); unknown types and columns are passed over."""
    plan = json.loads(plan) if isinstance(plan, str) else plan
    casts = {c: F.col(c).cast(CASTS[t]) for t, names in plan.items() if t in CASTS for c in names if c in df.columns}
    return df.withColumns(casts) if casts else df


def all_string(df: DataFrame) -> DataFrame:
    """64-bit integers as text."""
    wide = [f.name for f in df.schema if isinstance(f.dataType, T.LongType) or isinstance(f.dataType, T.DecimalType) and f.dataType.scale == 0]
    return df.withColumns({c: F.col(c).cast("string") for c in wide}) if wide else df


def category_levels(df: DataFrame, column: str, most: int = 100_000) -> list[str]:
    """Distinct non-empty texts in alphabetical order; an error beyond ``most``."""
    rows = df.select(column).filter(F.col(column).isNotNull() & (F.col(column) != "")).distinct().limit(most + 1).collect()
    require(len(rows) <= most, 198, f"{column} has more than {most} categories")
    return sorted(r[0] for r in rows)


def encode_categories(df: DataFrame, columns: list[str], mode: str = "encode") -> DataFrame:
    """Codes 1..K in alphabetical order for text columns, with their value labels as metadata.

    encode: codes replace the texts; raw: nothing changes; both: texts stay and ``<name>_id`` (or ``<name>_catid``) is added. Null and
    empty texts have no code.
    """
    require(mode in ("encode", "raw", "both"), 198, f"unknown catmode {mode}")
    if mode == "raw":
        return df
    for i, name in enumerate(columns, 1):
        levels = category_levels(df, name)
        codes = df.sparkSession.createDataFrame(list(zip(levels, range(1, len(levels) + 1), strict=True)), "_text string, _code int")
        target = name
        if mode == "both":
            target = next((c for c in (f"{name}_id", f"{name}_catid") if c not in df.columns), "")
            if not target:
                raise EngineError(198, f"no free name for the codes of {name}")
        meta = {"value_label": f"cat_{i}", "value_labels": {str(k): v for k, v in enumerate(levels, 1)}, "label": _label(df, name)}
        kept = [F.col(c) for c in df.columns]
        joined = df.join(F.broadcast(codes), F.col(name) == F.col("_text"), "left")  # at most 100,000 levels
        code = F.col("_code").alias(target, metadata=meta)
        df = joined.select(*[code if mode == "encode" and c == name else x for c, x in zip(df.columns, kept, strict=True)], *([code] if mode == "both" else []))
    return df


def _label(df: DataFrame, name: str) -> str:
    return (df.schema[name].metadata or {}).get("label", "")


def append_rows(*frames: DataFrame) -> DataFrame:
    """All rows by column name; columns that a table lacks are null, and types widen."""
    out = frames[0]
    for more in frames[1:]:
        both = {f.name: (f.dataType, more.schema[f.name].dataType) for f in out.schema if f.name in more.columns}
        for name, (a, b) in both.items():
            if a != b:
                kind = widest(a, b)
                out, more = out.withColumn(name, F.col(name).cast(kind)), more.withColumn(name, F.col(name).cast(kind))
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def widest(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds both: byte, int, long, double; numbers with texts become text."""
    ladder = [T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType]
    kinds = [type(a), type(b)]
    if all(k in ladder for k in kinds):
        if T.FloatType in kinds and any(k in (T.IntegerType, T.LongType) for k in kinds):
            return T.DoubleType()
        return max((a, b), key=lambda x: ladder.index(type(x)))
    return a if a == b else T.StringType()


def first_of_each(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """The first row of each key in the given order."""
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def number_rows(df: DataFrame, by: list[str], order_by: list[str], name: str = "index") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order_by)))


def group_number(df: DataFrame, keys: list[str], name: str = "group") -> DataFrame:
    """Number of each distinct key from 1 in order of the keys, null keys included; made from the distinct keys, not from all rows."""
    levels = df.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).distinct()
    numbered = number_in_order(levels, [F.col(f"_k{i}").asc_nulls_last() for i in range(len(keys))], name).withColumn(name, F.col(name).cast("int"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return df.join(numbered, same, "left").select(*df.columns, name)


def group_value(df: DataFrame, by: list[str], column: str, how: str, name: str) -> DataFrame:
    """A sum or maximum over each group beside every row."""
    require(how in ("sum", "max", "min", "count"), 198, f"unknown {how}")
    return df.withColumn(name, getattr(F, how)(column).over(Window.partitionBy(*by)))


def expand_rows(df: DataFrame, n: int, name: str = "copy") -> DataFrame:
    """Each row ``n`` times, numbered from 0."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def decode_labels(df: DataFrame, column: str, labels: dict[int, str], name: str) -> DataFrame:
    """The label of each code, or the code as text where it has none."""
    table = F.create_map(*[x for k, v in labels.items() for x in (F.lit(k), F.lit(v))]) if labels else None
    text = F.col(column).cast("string")
    return df.withColumn(name, text if table is None else F.coalesce(table[F.col(column).cast("int")], text))
