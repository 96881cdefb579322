"""Rows as JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_messages(df: DataFrame) -> DataFrame:
    """One JSON object per row in ``value``; NULL fields are left out and read back as NULL."""
    return df.select(F.to_json(F.struct("*")).alias("value"))
