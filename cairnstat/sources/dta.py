"""Files of the host program, read and written on the driver in pieces (small data only)."""

from __future__ import annotations

import os
import tempfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from ..errors import require
from ..operators.metadata import annotate, keep_metadata
from ..operators.select import all_string
from . import parquetio

MOST_ROWS = 5_000_000


def read_dta(spark: SparkSession, path: str, chunk: int = 200_000) -> DataFrame:
    """Rows with variable and value labels as metadata. Pieces go through temporary Parquet, not through one large table in memory."""
    require(os.path.exists(path), 601, f"file {path} not found")
    folder = tempfile.mkdtemp(prefix="cairnstat-dta-")
    with pd.read_stata(path, iterator=True, convert_categoricals=False, chunksize=chunk) as reader:
        names, values = reader.variable_labels(), reader.value_labels()
        owners = dict(zip(reader._varlist, reader._lbllist, strict=False)) if hasattr(reader, "_lbllist") else {}
        for k, part in enumerate(reader):
            part.to_parquet(f"{folder}/part-{k:05d}.parquet", index=False)
    df = spark.read.parquet(folder)
    for name in df.columns:
        meta = {"label": names.get(name, "")} if names.get(name) else {}
        label = owners.get(name)
        if label and label in values:
            meta |= {"value_label": label, "value_labels": {str(int(k)): v for k, v in values[label].items()}}
        if meta:
            df = annotate(df, name, **meta)
    return df


def write_dta(df: DataFrame, path: str, *, replace: bool = False, nolabel: bool = False) -> str:
    """At most MOST_ROWS rows, with variable and value labels."""
    require(replace or not os.path.exists(path), 602, f"file {path} already exists")
    n = df.count()
    require(n <= MOST_ROWS, 198, f"{n} rows are too many for one file")
    metas = {f.name: f.metadata or {} for f in df.schema}
    pdf = df.toPandas()
    wide = {c: "float64" for c in pdf.columns if str(pdf[c].dtype) == "int64"}
    pdf = pdf.astype(wide)
    labels = {} if nolabel else {c: m["label"][:80] for c, m in metas.items() if m.get("label")}
    values = {} if nolabel else {c: {int(k): v for k, v in m["value_labels"].items()} for c, m in metas.items() if m.get("value_labels") and pd.api.types.is_numeric_dtype(pdf[c])}
    pdf.to_stata(path, write_index=False, variable_labels=labels, value_labels=values, version=118)
    return path


def export(spark: SparkSession, target: str, source: str, *, replace: bool = False, nolabel: bool = False, chunksize: int | None = None) -> str:
    """A .dta file as Parquet."""
    return parquetio.write(read_dta(spark, source), target, replace=replace, nolabel=nolabel)


def import_(spark: SparkSession, target: str, source: str, *, replace: bool = False, nolabel: bool = False, allstring: bool = False, chunksize: int | None = None) -> str:
    """Parquet as a .dta file."""
    df = parquetio.read(spark, source, nolabel=nolabel)
    return write_dta(keep_metadata(all_string(df), df) if allstring else df, target, replace=replace, nolabel=nolabel)
