"""Texts of results: statistic labels, cleaned variable labels, number formats, value texts."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Label of each statistic.
STAT_LABELS = {
    "count": "Number of observations",
    "mean": "Mean",
    "median": "Median",
    "sd": "Standard deviation",
    "semean": "Standard error of the mean",
    "sebinomial": "Standard error of the mean (binomial)",
    "sepoisson": "Standard error of the mean (Poisson)",
    "sum": "Sum",
    "rawsum": "Unweighted sum",
    "percent": "Percentage of observations",
    "max": "Maximum",
    "min": "Minimum",
    "iqr": "Interquartile range",
    "first": "First value",
    "last": "Last value",
    "firstnm": "First nonmissing value",
    "lastnm": "Last nonmissing value",
}


def ordinal(n: int) -> str:
    if n % 100 in (11, 12, 13):
        return f"{n}th"
    return f"{n}{ {1: 'st', 2: 'nd', 3: 'rd'}.get(n % 10, 'th') }"


def stat_label(stat: str) -> str:
    if m := re.fullmatch(r"p(\d{1,2})", stat):
        return f"{ordinal(int(m[1]))} percentile"
    return STAT_LABELS.get(stat, stat)


def clean_label(label: str) -> str:
    """``A1. Age`` is ``Age``: what follows the first point and one more character."""
    return label[label.index(".") + 2 :] if "." in label else label


def clean_label_column(label: Column) -> Column:
    return F.when(F.instr(label, ".") > 0, F.substring(label, F.instr(label, ".") + F.lit(2), F.length(label))).otherwise(label)


def number_text(x: Column) -> Column:
    """A number as text, whole ones without decimals."""
    return F.when(x == F.floor(x), F.floor(x).cast("bigint").cast("string")).otherwise(x.cast("double").cast("string"))


def suffix(level: float) -> str:
    """A cross level as the end of a column name."""
    text = str(int(level)) if float(level).is_integer() else repr(float(level))
    return text.replace("-", "m").replace(".", "_")


def auto_format(kind: T.DataType, low: float | None, high: float | None, decimals: bool, *, labelled: bool = False, width: int = 9, override: str | None = None) -> str:
    """Display format of a result column from its range."""
    if isinstance(kind, T.StringType) or labelled:
        return f"%-{max(1, width)}s" if isinstance(kind, T.StringType) else f"%-{max(8, width)}.0g"
    if isinstance(kind, T.DateType):
        return "%td"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return "%tc"
    if override:
        return override
    if low is None or high is None:
        return "%9.0f"
    if 0 <= low and high <= 1:
        return "%7.3f"
    top = max(abs(low), abs(high))
    digits = max(1, math.floor(math.log10(top)) + 1) if top > 0 else 1
    more = 2 if decimals else 0
    if high >= 1000:
        return f"%{digits + (digits - 1) // 3 + 2 + more}.{'1' if decimals else '0'}fc"
    return f"%{digits + 2 + more}.{'1' if decimals else '0'}f"


def storage_type(kind: T.DataType) -> str:
    """Short name of the storage type of a column."""
    names = {T.BooleanType: "byte", T.ByteType: "byte", T.ShortType: "int", T.IntegerType: "long", T.LongType: "double", T.FloatType: "float", T.DoubleType: "double", T.DateType: "date", T.TimestampType: "datetime", T.TimestampNTZType: "datetime", T.StringType: "string", T.BinaryType: "strl"}
    return names.get(type(kind), "double" if isinstance(kind, T.DecimalType) and kind.scale == 0 else "strl")


def default_format(storage: str, length: int | None = None) -> str:
    """Display format of a storage type as files are described."""
    if storage in ("byte", "int", "long", "date", "time", "datetime"):
        return "%12.0f"
    if storage in ("float", "double"):
        return "%12.2f"
    return "%9s" if storage == "strl" or length is None else f"%{max(9, length)}s"
