"""Descriptive analytics on Spark: tables in, reusable result tables out."""

from .errors import EngineError, UnsupportedExpression
from .frames import Frames
from .operators.metadata import Metadata, describe_metadata
from .operators.summary import summarize
from .operators.tables import tabulate
from .operators.weights import Weight
from .sources.parquetio import describe, read, write

__all__ = ["EngineError", "Frames", "Metadata", "UnsupportedExpression", "Weight", "describe", "describe_metadata", "read", "summarize", "tabulate", "write"]
