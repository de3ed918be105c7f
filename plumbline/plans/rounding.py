"""Rounding of results for comparison and export, driven by types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Double and float columns rounded half up; others as they are."""
    return df.select(*[F.round(c, digits).alias(c) if kind in ("double", "float") else F.col(c) for c, kind in df.dtypes])
