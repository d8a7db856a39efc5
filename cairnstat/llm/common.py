"""What the corpus operators share: reading tables, cutting lineage, lean Python workers, let-bindings, tokenizer files."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the contracts: blank and U+0009 to U+000D.
SPACES = " \t\n\x0b\f\r"
WORD_BREAK = "[\\x20\\x09-\\x0D]+"
#: What an Arrow batch to a Python worker holds at most (one row if it is longer), so that its memory doesn't follow the number of rows.
BATCH_BYTES = 4 << 20
#: Stands for a null key where keys are compared.
NO_ID = -(1 << 63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: the session's checkpoint folder. Where that is unset, a temporary folder if driver and
    executors are one process, and an error on a cluster."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = getattr(spark, "_cairnstat_tmp", None) or tempfile.mkdtemp(prefix="cairnstat-")
        spark._cairnstat_tmp = found
    return found.rstrip("/")


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: lineage ends there, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_at = path
    return out


def drop(*cuts: DataFrame) -> None:
    """Delete what ``cut`` wrote, once nothing that is still to run reads it."""
    for df in cuts:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._cut_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_kept: dict[Any, Any] = {}


def kept(name: Any, make: Callable[[], Any]) -> Any:
    """The one heavy object that a Python worker keeps between tasks: the last one asked for."""
    if name not in _kept:
        _kept.clear()
        _kept[name] = make()
    return _kept[name]


def forget(keeps: Any = None) -> None:
    """Drop what earlier tasks of this worker kept, but for the object of that name."""
    if keeps not in _kept:
        _kept.clear()


def give_back() -> None:
    """Return free memory to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def arrow_map(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: Any, keeps: Any = None) -> DataFrame:
    """``df.mapInArrow`` for workers with little memory, as executors reuse them for whatever comes next.

    Batches of more than BATCH_BYTES are made smaller (a setting of the session). A task begins without what others kept, but for the
    object named ``keeps``, and returns free memory to the system at its end.
    """
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = df.sparkSession.conf.get(setting).lower().rstrip("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        df.sparkSession.conf.set(setting, str(BATCH_BYTES))

    def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget(keeps)
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(lean, schema)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``, inside lambdas as well."""
    return F.element_at(F.transform(F.array(value), body), 1)


def utf8(text: Column) -> Column:
    """UTF-8 bytes of a text; null as no bytes."""
    return F.coalesce(text, F.lit("")).cast("binary")


def text_hash(text: str) -> Column:
    """Tells rows with one key apart by their texts; null and empty are the same."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def row_id(key: str) -> Column:
    """The key as a number, NO_ID for null."""
    return F.coalesce(F.col(key).cast("long"), F.lit(NO_ID))


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)
