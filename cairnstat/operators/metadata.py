"""Metadata about a table: variables, value labels, notes, and the table itself.

What belongs to a column travels in its field's metadata (label, value_label, value_labels, format, notes); what belongs to the table is in
a ``Metadata`` bundle, which is stored beside Parquet files as JSON.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from datetime import datetime
from typing import ClassVar

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import require
from ..functions.labels import default_format, storage_type

SCHEMA_VERSION = 1


@dataclass
class Metadata:
    """Bundle in the stored form. ``min_reader_version`` above this library's version is an error."""

    vars: list[dict] = field(default_factory=list)
    value_labels: list[dict] = field(default_factory=list)
    dta_label: str = ""
    dta_ts: str = ""
    dta_obs: int = 0
    dta_vars: int = 0
    dta_notes: list[str] = field(default_factory=list)
    var_notes: list[dict] = field(default_factory=list)
    schema_version: int = SCHEMA_VERSION
    min_reader_version: int = 1

    def to_json(self) -> str:
        return json.dumps(asdict(self), ensure_ascii=False)

    @classmethod
    def from_json(cls, text: str) -> Metadata:
        data = json.loads(text)
        require(int(data.get("min_reader_version", 1)) <= SCHEMA_VERSION, 459, "the metadata needs a newer reader")
        names = cls.__dataclass_fields__
        found = cls(**{k: v for k, v in data.items() if k in names})
        for own in found.value_labels:
            for v in own.get("values", []):
                require(str(v["value"]).lstrip("-").isdigit(), 198, f"value label {own['name']} has a key that is not an integer")
        return found

    #: Names that bundles in the footers of other writers use for what ``vars`` calls type, varlab and vallab.
    FOOTER_NAMES: ClassVar[dict[str, str]] = {"stata_type": "type", "var_label": "varlab", "value_label": "vallab"}

    @classmethod
    def from_footer(cls, text: str) -> Metadata:
        """A bundle from a file's footer. Its value labels may be flat, one {name, value, text} for each code."""
        data = json.loads(text)
        data["vars"] = [{cls.FOOTER_NAMES.get(k, k): x for k, x in v.items()} for v in data.get("vars", [])]
        sets: dict[str, list[dict]] = {}
        for v in data.get("value_labels", []):
            sets.setdefault(v["name"], []).extend(v["values"] if "values" in v else [{"value": v["value"], "text": v["text"]}])
        data["value_labels"] = [{"name": k, "values": own} for k, own in sets.items()]
        return cls.from_json(json.dumps(data))

    @classmethod
    def of(cls, df: DataFrame, *, label: str = "", notes: list[str] | None = None, nolabel: bool = False) -> Metadata:
        """Bundle of a table's columns; without labels and notes under ``nolabel``."""
        made = cls(dta_label="" if nolabel else label, dta_notes=[] if nolabel else list(notes or []), dta_vars=len(df.columns), dta_ts=datetime.now().strftime("%d %b %Y %H:%M"))
        seen: dict[str, dict] = {}
        for f in df.schema:
            m = f.metadata or {}
            kind = m.get("storage_type") or storage_type(f.dataType)
            made.vars.append({"name": f.name, "type": kind, "format": m.get("format") or default_format(kind), "varlab": "" if nolabel else m.get("label", ""), "vallab": "" if nolabel else m.get("value_label", "")})
            if nolabel:
                continue
            if m.get("value_labels"):
                seen[m.get("value_label") or f.name] = m["value_labels"]
            made.var_notes += [{"varname": f.name, "text": t} for t in m.get("notes", [])]
        made.value_labels = [{"name": k, "values": [{"value": int(v), "text": t} for v, t in sorted(own.items(), key=lambda x: int(x[0]))]} for k, own in seen.items()]
        return made

    def apply(self, df: DataFrame) -> DataFrame:
        """``df`` with the stored labels, formats and notes on the columns that it has."""
        labels = {own["name"]: {str(v["value"]): v["text"] for v in own["values"]} for own in self.value_labels}
        for v in self.vars:
            if v["name"] in df.columns:
                meta = dict(df.schema[v["name"]].metadata or {})
                meta |= {k: x for k, x in (("label", v.get("varlab")), ("value_label", v.get("vallab")), ("format", v.get("format")), ("storage_type", v.get("type"))) if x}
                if v.get("vallab") in labels:
                    meta["value_labels"] = labels[v["vallab"]]
                notes = [n["text"] for n in self.var_notes if n["varname"] == v["name"]]
                df = df.withMetadata(v["name"], meta | ({"notes": notes} if notes else {}))
        return df


def annotate(df: DataFrame, column: str, **meta) -> DataFrame:
    """``df`` with label=, value_label=, value_labels=, format= or notes= on a column."""
    require(column in df.columns, 111, f"variable {column} not found")
    if "value_labels" in meta:
        meta["value_labels"] = {str(k): v for k, v in meta["value_labels"].items()}
        meta.setdefault("value_label", column)
    return df.withMetadata(column, (df.schema[column].metadata or {}) | meta)


def keep_metadata(df: DataFrame, source: DataFrame) -> DataFrame:
    """``df`` with the metadata that columns of the same name have in ``source``."""
    for f in source.schema:
        if f.metadata and f.name in df.columns and not df.schema[f.name].metadata:
            df = df.withMetadata(f.name, f.metadata)
    return df


def describe_metadata(df: DataFrame, *, label: str = "", notes: list[str] | None = None, save: str | None = None, replace: bool = False) -> dict[str, DataFrame]:
    """_dtvars and _dtinfo always; _dtlabel and _dtnotes if there is anything in them. Reads the table only to count it."""
    require(save is not None or not replace, 198, "replace needs save")
    spark, bundle = df.sparkSession, Metadata.of(df, label=label, notes=notes)
    require(bool(df.columns), 198, "no data")
    out = {"_dtvars": spark.createDataFrame(
        [("variable", k, v["name"], v["type"], v["format"], v["vallab"], v["varlab"]) for k, v in enumerate(bundle.vars, 1)],
        "_level string, position int, varname string, type string, format string, vallab string, varlab string")}
    users: dict[str, list[str]] = {}
    for v in bundle.vars:
        users.setdefault(v["vallab"] or v["name"], []).append(v["name"])
    rows = [("value label", " ".join(users.get(own["name"], [])), k, own["name"], v["value"], v["text"], 0) for own in bundle.value_labels for k, v in enumerate(own["values"], 1)]
    if rows:
        out["_dtlabel"] = spark.createDataFrame(rows, "_level string, varname string, index int, vallab string, value long, label string, trunc int")
    counted: dict[str, int] = {}
    rows = []
    for n in bundle.var_notes:
        counted[n["varname"]] = counted.get(n["varname"], 0) + 1
        rows.append(("variable", n["varname"], counted[n["varname"]], n["text"]))
    if rows:
        out["_dtnotes"] = spark.createDataFrame(rows, "_level string, varname string, _note_id int, _note_text string")
    info = [("dataset", k, t) for k, t in enumerate(bundle.dta_notes, 1)] or [("", 0, "")]
    out["_dtinfo"] = spark.createDataFrame(info, "_level string, _note_id int, _note_text string").crossJoin(df.agg(F.count("*").alias("dta_obs"))).select(
        "_level", "dta_obs", F.lit(len(df.columns)).alias("dta_vars"), F.lit(label).alias("dta_label"), F.lit(bundle.dta_ts).alias("dta_ts"), "_note_id", "_note_text")
    if save:
        from ..sources.xlsx import save_tables

        save_tables({{"_dtvars": "Variables", "_dtlabel": "Value labels", "_dtnotes": "Notes", "_dtinfo": "Dataset"}[k]: v for k, v in out.items()}, save, replace=replace)
    return out


@dataclass
class Described:
    """What a description returns besides its tables: rows, columns, names, and the names of value label sets."""

    N: int
    k: int
    varlist: str
    labels: str
    source: str = ""


def returned(df: DataFrame, source: str = "") -> Described:
    """Reads the table only to count it."""
    labels = sorted({f.metadata.get("value_label") or f.name for f in df.schema if (f.metadata or {}).get("value_labels")})
    return Described(df.count(), len(df.columns), " ".join(df.columns), " ".join(labels), source)


def report(frames: dict[str, DataFrame]) -> dict[str, int]:
    """Rows of each frame."""
    return {k: v.count() for k, v in frames.items()}
