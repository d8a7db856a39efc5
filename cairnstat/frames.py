"""Named result tables, and the resolution of a command's source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .errors import require


class Frames:
    """Registry of named tables; each is a temporary view as well. Setting a name again replaces it."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._held: dict[str, DataFrame] = {}

    def put(self, name: str, df: DataFrame) -> DataFrame:
        self._held[name] = df
        df.createOrReplaceTempView(name)
        return df

    def get(self, name: str) -> DataFrame:
        require(name in self._held, 111, f"frame {name} not found")
        return self._held[name]

    def names(self) -> list[str]:
        return sorted(self._held)

    def drop(self, name: str) -> None:
        require(name in self._held, 111, f"frame {name} not found")
        del self._held[name]
        self.spark.catalog.dropTempView(name)

    def clear(self) -> None:
        for name in self.names():
            self.drop(name)


def resolve(source: DataFrame | str, spark: SparkSession | None = None) -> DataFrame:
    """A table as it is, or what is read from a .parquet or .dta path."""
    if isinstance(source, DataFrame):
        return source
    spark = spark or SparkSession.active()
    if source.lower().endswith(".dta"):
        from .sources.dta import read_dta

        return read_dta(spark, source)
    from .sources.parquetio import read

    return read(spark, source)
