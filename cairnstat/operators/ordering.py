"""Numbers of rows in a global order, without a step in which one task sees all rows."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import EngineError

#: ``monotonically_increasing_id`` has the partition above these bits and the place within it in them.
PLACE = (1 << 33) - 1


def shared_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share: within spark.checkpoint.dir, or a temporary one in local mode."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise EngineError(198, "set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = getattr(spark, "_cairnstat_files", None) or tempfile.mkdtemp(prefix="cairnstat-")
        spark._cairnstat_files = base
    return f"{base.rstrip('/')}/files-{uuid.uuid4().hex}"


def number_in_order(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with each row's number from 1 in the given order; ties are numbered in any order, but for good.

    Rows are dealt by ranges of the order, sorted and written, so that their places don't change; what reaches the driver is one count
    for each partition.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = shared_folder(spark)
    placed = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    placed.withColumns({"_part": F.shiftright("_id", 33), "_at": F.col("_id").bitwiseAND(F.lit(PLACE))}).drop("_id").write.parquet(path)
    back = spark.read.schema(T.StructType([*df.schema, T.StructField("_part", T.LongType()), T.StructField("_at", T.LongType())])).parquet(path)
    ahead, offsets = 0, []
    for part, n in sorted(map(tuple, back.groupBy("_part").count().collect())):  # a row for each partition
        offsets.append((part, ahead))
        ahead += n
    before = spark.createDataFrame(offsets, "_part long, _before long")
    return back.join(F.broadcast(before), "_part").select(*df.columns, (F.col("_before") + F.col("_at") + 1).alias(name))
