"""Weights of rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import require

KINDS = ("fweight", "aweight", "iweight", "pweight")


@dataclass(frozen=True)
class Weight:
    """``kind`` and the column (name or expression) that holds the weight."""

    kind: str
    by: str | Column

    def __post_init__(self):
        require(self.kind in KINDS, 198, f"unknown weight {self.kind}")

    @property
    def column(self) -> Column:
        return F.col(self.by) if isinstance(self.by, str) else self.by


def weighted(df: DataFrame, weight: Weight | None, name: str = "_w") -> DataFrame:
    """``df`` with the weight as a column, without rows of null or zero weight; without a weight every row has 1."""
    if weight is None:
        return df.withColumn(name, F.lit(1.0))
    return df.withColumn(name, weight.column.cast("double")).filter(F.col(name) != 0)
