"""CSV result files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession


def result_name(as_of: dt.date) -> str:
    # Fixed value: the form of the result name.
    return f"analytic_result_{as_of:%Y_%m_%d}"


def export_csv(df: DataFrame, path: str, order_by: str) -> None:
    """CSV with header, overwriting, ordered by a column across its part files.

    Rows are range-partitioned, so part files follow each other in order and no task holds the whole result.
    """
    df.orderBy(order_by).write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)
