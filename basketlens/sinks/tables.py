"""Partitioned parquet writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def load_month(load_column: str = "load_date") -> Column:
    """The partition a row belongs to, as text such as '202405'."""
    return F.date_format(load_column, "yyyyMM")


def by_month(df: DataFrame, order_key: str, load_column: str = "load_date") -> DataFrame:
    """Rows arranged for a table partitioned by load month and ordered by load time and id.

    The rebalance hint groups rows by month but lets adaptive execution cut a month into parts of the
    advisory size: a daily load is a single month, and a plain repartition by month would push all of
    it through one task.
    """
    return (
        df.withColumn("load_month", load_month(load_column))
        .hint("rebalance", F.col("load_month"))
        .sortWithinPartitions("load_month", load_column, order_key)
    )


def write_monthly(df: DataFrame, path: str, order_key: str, load_column: str = "load_date", mode: str = "append") -> None:
    by_month(df, order_key, load_column).write.mode(mode).partitionBy("load_month").parquet(path)


def write_batch(df: DataFrame, table: str, batch_id: int, *partition_by: str, row_group: int | None = None) -> str:
    """Write one micro-batch to its own folder and return the folder. ``row_group`` is the size of row groups in bytes: a
    reader gives a group to one task, so a file of several can be read by several.

    Appending parquet is not atomic; overwriting ``run=<id>/batch_id=<n>`` is repeatable, so a batch replayed
    after a failure leaves the table as one successful run would. The id is that of the stream, which is kept in its
    checkpoint: a stream with a new checkpoint counts its batches anew but overwrites none of an earlier one.
    """
    run = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
    path = f"{table}/run={run}/batch_id={batch_id}"
    writer = df.write.mode("overwrite")
    if row_group:
        writer = writer.option("parquet.block.size", row_group)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def write_routed(df: DataFrame, table: str, batch_id: int, *partition_by: str) -> None:
    """Write one micro-batch to all tables that its rows belong to, as one job.

    The tables are told by the partition columns; below them stand the stream and the batch, and only the folders that
    the batch writes to are overwritten, so a replay is repeatable like that of `write_batch`. A reader of one table
    and month lists the folders of that month only.
    """
    run = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
    named = df.withColumns({"run": F.lit(run), "batch_id": F.lit(batch_id)})
    writer = named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by, "run", "batch_id").parquet(table)
