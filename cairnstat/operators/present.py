"""Display formats of result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.labels import auto_format


def with_formats(df: DataFrame, override: str | None = None) -> DataFrame:
    """``df`` with a display format on every column, from its range and whether it has decimals (one pass over the result).

    ``override`` replaces those of plain numbers; texts, dates and labelled columns keep theirs.
    """
    numbers = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    aggs = [x for c in numbers for x in (F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}"), F.max(F.col(c).cast("double") != F.floor(F.col(c).cast("double"))).alias(f"de_{c}"))]
    aggs += [F.max(F.length(c)).alias(f"le_{c}") for c in texts]
    found = df.agg(*aggs).first().asDict() if aggs else {}
    for f in df.schema:
        meta = dict(f.metadata or {})
        number = lambda k, c=f.name: None if found.get(f"{k}_{c}") is None else float(found[f"{k}_{c}"])
        made = auto_format(f.dataType, number("lo"), number("hi"), bool(found.get(f"de_{f.name}")), labelled=bool(meta.get("value_labels")), width=int(found.get(f"le_{f.name}") or 9), override=override)
        df = df.withMetadata(f.name, meta | {"format": made})
    return df
