"""Parquet in and out.

Reading is one lazy plan: scan, row window, filter, projection, casts, categories. Without a row window the filter and the projection
reach the scan. A row window numbers rows by file and position in the file: one count for each file, and no sort.
"""

from __future__ import annotations

import base64
import re
import uuid
import warnings
from collections.abc import Sequence

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import EngineError, require
from ..functions.expressions import filter_rows
from ..functions.labels import default_format, storage_type
from ..operators.metadata import Metadata, keep_metadata
from ..operators.select import all_string, append_rows, cast_columns, encode_categories, match_columns, sample_rows, sort_rows

SIDECAR = "_dtmeta.json"
#: Where a row of a widened scan came from.
PATH_OF, INDEX_OF = "_cairnstat_path", "_cairnstat_index"
#: Presets and codecs; brotli and lzo need codecs that Spark lacks, and become zstd.
CODECS = {"fast": "lz4_raw", "balanced": "zstd", "archive": "zstd", "lz4": "lz4_raw", "uncompressed": "uncompressed", "snappy": "snappy", "gzip": "gzip", "zstd": "zstd", "brotli": "zstd", "lzo": "zstd"}
LONGEST_STR = 2045


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    if re.search(r"[*?\[]", path):
        return len(fs.globStatus(p) or []) > 0
    return fs.exists(p)


def _holds_parquet(fs, status, depth: int) -> bool:
    """Whether a folder or something in it, down to ``depth`` levels, is named .parquet. Stops at the first one."""
    if status.getPath().getName().lower().endswith(".parquet"):
        return True
    return depth > 0 and status.isDirectory() and any(_holds_parquet(fs, s, depth - 1) for s in fs.listStatus(status.getPath()))


def found_path(spark: SparkSession, path: str) -> str:
    """The path as it is or with ``.parquet`` added, whichever is there. A folder needs a Parquet file within three levels."""
    for p in (path, f"{path}.parquet"):
        if exists(spark, p):
            if not re.search(r"[*?\[]", p):
                fs, at = _fs(spark, p)
                status = fs.getFileStatus(at)
                require(not status.isDirectory() or _holds_parquet(fs, status, 3), 601, f"no Parquet file in {p}")
            return p
    raise EngineError(601, f"file {path} not found")


def _scan_widened(spark: SparkSession, paths: Sequence[str], recursive: bool) -> DataFrame:
    """Files whose columns differ in type: those of one schema are one scan, and the scans are appended with the wider types. Keeps the
    place of each row in columns of its own, as the union has no file metadata."""
    alike: dict[str, list[str]] = {}
    for p in paths:
        alike.setdefault(_reader(spark, False, recursive).parquet(p).schema.json(), []).append(p)
    return append_rows(*[_reader(spark, False, recursive).parquet(*own).select("*", F.col("_metadata.file_path").alias(PATH_OF), F.col("_metadata.row_index").alias(INDEX_OF)) for own in alike.values()])


def _matches(spark: SparkSession, path: str) -> list[str]:
    """What a glob stands for, in order of name; a plain path is itself."""
    if not re.search(r"[*?\[]", path):
        return [path]
    fs, p = _fs(spark, path)
    return sorted(s.getPath().toString() for s in fs.globStatus(p))


def _place(df: DataFrame) -> tuple:
    """File and position of a row of a scan."""
    return (F.col(PATH_OF), F.col(INDEX_OF)) if PATH_OF in df.columns else (F.col("_metadata.file_path"), F.col("_metadata.row_index"))


def _reader(spark: SparkSession, merge: bool, recursive: bool):
    reader = spark.read.option("mergeSchema", merge)
    return reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet") if recursive else reader


def _scan(spark: SparkSession, path: str | Sequence[str], merge: bool, recursive: bool) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    try:
        return _reader(spark, merge, recursive).parquet(*paths)
    except (PySparkException, Py4JJavaError) as e:  # which one depends on where Spark meets the difference
        if "CANNOT_MERGE" not in str(e):
            raise
        return _scan_widened(spark, [q for p in paths for q in _matches(spark, p)], recursive)


def number_rows_by_file(df: DataFrame, name: str = "_row") -> DataFrame:
    """``df``, straight from files, with each row's number from 1 in order of file and position."""
    file, position = _place(df)
    placed = df.withColumns({"_file": file, "_at": position})
    counts = df.select(file.alias("f")).groupBy("f").count().orderBy("f").collect()  # a row for each file
    ahead, offsets = 0, []
    for path, n in counts:
        offsets.append((path, ahead))
        ahead += n
    if len(offsets) == 1:
        return placed.withColumn(name, F.col("_at") + 1).drop("_file", "_at")
    table = df.sparkSession.createDataFrame(offsets, "_f string, _before long")
    joined = placed.join(table, placed["_file"] == table["_f"])
    return joined.withColumn(name, F.col("_before") + F.col("_at") + 1).drop("_file", "_at", "_f", "_before")


def filename_column(df: DataFrame, pattern: str, name: str) -> DataFrame:
    """The text that the first ``*`` of the path pattern stands for: whole numbers or numbers if it is one in all files, else texts."""
    head, _, tail = pattern.partition("*")
    tail = tail.split("*")[0]
    cut = f"{re.escape(head)}(.*?){re.escape(tail)}(?:$|/)" if tail else f"{re.escape(head)}([^/]*)"
    texts = [m[1] if (m := re.search(cut, p)) else "unknown" for p in df.inputFiles()]
    kind = "long" if all(re.fullmatch(r"[+-]?\d{1,18}", t) for t in texts) else "double" if all(re.fullmatch(r"[+-]?\d*\.?\d+", t) for t in texts) else "string"
    found = F.regexp_extract(_place(df)[0], cut, 1)
    return df.withColumn(name, F.when(found == "", "unknown").otherwise(found).cast(kind))


def read(
    spark: SparkSession, path: str | Sequence[str], columns: str | Sequence[str] | None = None, where=None, window: tuple[int, int] | None = None, *, nolabel: bool = False, allstring: bool = False, catmode: str = "raw",
    categories: Sequence[str] = (), casts=None, sort: str | Sequence[str] | None = None, sample: float | None = None, seed: int = 0, recursive: bool = False, filename: str | None = None, metadata_key: str | None = None,
    chunksize: int | None = None,
) -> DataFrame:
    """Rows of Parquet files, folders, globs or lists of them. The window comes before the filter; columns of several types get the wider one.

    ``columns`` are names with ``*`` and ``?``. ``categories`` names text columns to encode by ``catmode``; without it those are that
    the first file's Arrow schema has as dictionaries. ``filename`` adds a column from the glob. ``metadata_key`` names the footer's
    entry with a metadata bundle, if another writer put it there. ``chunksize`` is a hint that Spark doesn't need.
    """
    require(catmode in ("encode", "raw", "both"), 198, f"unknown catmode {catmode}")
    path = found_path(spark, path) if isinstance(path, str) else [found_path(spark, p) for p in path]
    df = base = _scan(spark, path, merge=not isinstance(path, str) or bool(re.search(r"[*?\[]", path)), recursive=recursive)
    names = match_columns(base.columns, list(columns) if not isinstance(columns, str) and columns else columns) if columns else [c for c in base.columns if c not in (PATH_OF, INDEX_OF)]
    if filename:
        require(isinstance(path, str) and "*" in path, 198, "filename needs a path with *")
        df = filename_column(df, path.rsplit("/", 1)[-1], filename)
        names = [*names, filename]
    if window:
        first, last = window
        df = number_rows_by_file(df).filter(F.col("_row").between(first, last))
    df = filter_rows(df, where)
    if sample is not None:
        df = sample_rows(df, sample, seed)
    if sort:
        df = sort_rows(df, sort)
    df = keep_metadata(df.select(*names), base)
    if casts:
        df = cast_columns(df, casts)
    if allstring:
        return all_string(df)
    stored = None if nolabel or not isinstance(path, str) else load_metadata(spark, path, metadata_key)
    if stored:
        df = stored.apply(df)
    elif catmode != "raw":
        encoded = list(categories) or [c for c in dictionary_columns(spark, path if isinstance(path, str) else path[0]) if c in df.columns]
        df = encode_categories(df, encoded, catmode) if encoded else df
    return df.select(*[F.col(c).alias(c, metadata={}) for c in df.columns]) if nolabel else df


def write(
    df: DataFrame, path: str, *, replace: bool = False, nolabel: bool = False, compress: str = "fast", partition_by: str | Sequence[str] = (), where=None, single: bool = False, label: str = "", notes: list[str] | None = None, chunksize: int | None = None,
) -> str:
    """Write a folder of Parquet files with its metadata beside them; returns the path.

    ``single`` writes one file instead of a folder: it is written aside and renamed, so there is the whole file or none; its bundle is a hidden
    file beside it. ``partition_by`` writes a folder for each value; keys read back as columns. ``chunksize`` bounds
    the rows of a file.
    """
    spark = df.sparkSession
    require(compress in CODECS, 198, f"unknown codec {compress}")
    if compress in ("lzo", "brotli"):
        warnings.warn(f"{compress} is not available; zstd is written", stacklevel=2)
    keys = partition_by.split() if isinstance(partition_by, str) else list(partition_by)
    for k in keys:
        require(k in df.columns, 111, f"variable {k} not found")
    path = re.sub(r"\.parquet$", "", path, flags=re.I) + ("" if keys else ".parquet")
    require(replace or not exists(spark, path), 602, f"file {path} already exists")
    out = filter_rows(df, where)
    if nolabel:
        out = out.select(*[F.col(c).alias(c, metadata={}) for c in out.columns])
    if single:
        out = out.coalesce(1)
    writer = out.write.mode("overwrite" if replace else "error").option("compression", CODECS[compress])
    if compress == "archive":
        writer = writer.option("parquet.compression.codec.zstd.level", 19)
    if chunksize:
        writer = writer.option("maxRecordsPerFile", chunksize)
    bundle = Metadata.of(df, label=label, notes=notes, nolabel=nolabel).to_json()
    if single and not keys:
        aside = f"{path}.{uuid.uuid4().hex}.tmp"
        fs, at = _fs(spark, path)
        try:
            writer.parquet(aside)
            parts = [s.getPath() for s in fs.listStatus(_fs(spark, aside)[1]) if s.getPath().getName().endswith(".parquet")]
            require(len(parts) == 1, 198, "a single file can't have a chunksize")
            if replace:
                fs.delete(at, True)
            require(fs.rename(parts[0], at), 602, f"file {path} can't be written")
        finally:
            fs.delete(_fs(spark, aside)[1], True)
        _put(spark, _beside(path), bundle)
        return path
    (writer.partitionBy(*keys) if keys else writer).parquet(path)
    _put(spark, f"{path}/{SIDECAR}", bundle)
    return path


def _beside(path: str) -> str:
    """Place of a single file's bundle; scans of the folder pass over names that begin with an underscore."""
    folder, _, name = path.rpartition("/")
    return f"{folder}/_{name}{SIDECAR}" if folder else f"_{name}{SIDECAR}"


def _put(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    stream = fs.create(p, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def _first_file(spark: SparkSession, path: str) -> str | None:
    """The first Parquet file of a path by name."""
    for p in _matches(spark, path):
        fs, at = _fs(spark, p)
        status = fs.getFileStatus(at)
        if status.isFile():
            return p
        for own in sorted(s.getPath().toString() for s in fs.listStatus(at)):
            name = own.rpartition("/")[2]
            if not name.startswith(("_", ".")) and (found := _first_file(spark, own)):
                return found
    return None


def footer_entries(spark: SparkSession, path: str) -> dict[str, str]:
    """Key and value entries of the footer of a path's first file; no rows are read."""
    first = _first_file(spark, path)
    if first is None:
        return {}
    parquet, conf = spark._jvm.org.apache.parquet.hadoop, spark._jsc.hadoopConfiguration()
    reader = parquet.ParquetFileReader.open(parquet.util.HadoopInputFile.fromPath(spark._jvm.org.apache.hadoop.fs.Path(first), conf))
    try:
        return dict(reader.getFooter().getFileMetaData().getKeyValueMetaData())
    finally:
        reader.close()


def has_metadata_key(spark: SparkSession, path: str, key: str) -> bool:
    return key in footer_entries(spark, found_path(spark, path))


def dictionary_columns(spark: SparkSession, path: str) -> list[str]:
    """Columns with an Arrow dictionary type of texts, as categories of other libraries are stored."""
    stored = footer_entries(spark, path).get("ARROW:schema")
    if not stored:
        return []
    schema = pa.ipc.read_schema(pa.py_buffer(base64.b64decode(stored)))
    return [f.name for f in schema if pa.types.is_dictionary(f.type) and (pa.types.is_string(f.type.value_type) or pa.types.is_large_string(f.type.value_type))]


def load_metadata(spark: SparkSession, path: str, key: str | None = None) -> Metadata | None:
    """The bundle beside the files, if any: in the folder, beside a single file, or in the folder of a partition's or part file's table. A
    glob has the bundle of its first match. With ``key``, else that entry of the first file's footer."""
    at = next(iter(_matches(spark, path)), path)
    places = [f"{at}/{SIDECAR}", _beside(at)]
    up = at
    for _ in range(8):  # part files lie in the table's folder, or below folders of partitions
        folder, _, name = up.rpartition("/")
        if not folder or not (up == at or "=" in name):
            break
        if "=" in name or name.startswith("part-"):
            places.append(f"{folder}/{SIDECAR}")
        up = folder
    for place in places:
        fs, p = _fs(spark, place)
        if fs.exists(p):
            stream = fs.open(p)
            text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            stream.close()
            return Metadata.from_json(text)
    found = footer_entries(spark, path).get(key) if key else None
    return Metadata.from_footer(found) if found else None


def describe(spark: SparkSession, path: str, *, detailed: bool = False, short: bool = False) -> tuple[dict, DataFrame | None]:
    """{N, k, varlist} and a row per column: varname, vartype, format, vallab, varlab. ``detailed`` measures texts, in one pass."""
    path = found_path(spark, path)
    df = _scan(spark, path, merge=False, recursive=False)
    stored = load_metadata(spark, path)
    df = stored.apply(df) if stored else df
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)] if detailed else []
    found = df.agg(F.count("*").alias("_n"), *[F.max(F.octet_length(c)).alias(c) for c in texts]).first()
    info = {"N": found["_n"], "k": len(df.columns), "varlist": " ".join(df.columns)}
    if short:
        return info, None
    rows = []
    for f in df.schema:
        m, kind, length = f.metadata or {}, storage_type(f.dataType), None
        if f.name in texts:
            length = found[f.name] or 0
            kind = "strl" if length > LONGEST_STR else f"str{length}" if length else "string"
        rows.append((f.name, m.get("storage_type", kind) if not texts else kind, m.get("format") or default_format("string" if kind.startswith("str") and kind != "strl" else kind, length), m.get("value_label", ""), m.get("label", "")))
    return info, spark.createDataFrame(rows, "varname string, vartype string, format string, vallab string, varlab string")
