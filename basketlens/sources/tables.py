"""Reads of RAW and MART tables, and of marts kept in a database."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens import schemas
from basketlens.files import Files
from basketlens.operators import dedup


def read_monthly(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table partitioned by ``load_month``. The schema is given: inference would read '202401' as a
    number."""
    return spark.read.schema(f"{schema}, load_month string").parquet(path)


def month_folders(spark: SparkSession, path: str, above: int = 0) -> dict[str, list[str]]:
    """The folders of each load month of a table, with `above` levels of folders over them. Names are listed, no file."""
    folders: dict[str, list[str]] = {}
    for folder in Files(spark, path).matching(f"{path}/{'*/' * above}load_month=*"):
        month = re.search(r"/load_month=(\d{6})\Z", folder)
        if month:
            folders.setdefault(month[1], []).append(folder)
    return folders


def _of_newest_month(table: DataFrame, path: str, above: int = 0) -> DataFrame:
    """Rows of the newest month, which is told by the names of folders: the scan has a constant filter."""
    newest = max(month_folders(table.sparkSession, path, above), default=None)
    return table.filter(F.lit(False) if newest is None else F.col("load_month") == newest)


def newest_monthly(spark: SparkSession, path: str, schema: str, load_column: str = "load_date") -> DataFrame:
    """The newest load of a monthly table; no other month is read."""
    return dedup.latest_snapshot(_of_newest_month(read_monthly(spark, path, schema), path), load_column)


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table written batch by batch, without the names of its streams and batches."""
    return spark.read.schema(f"{schema}, run string, batch_id bigint").parquet(path).drop("run", "batch_id")


def read_mart(spark: SparkSession, path: str, name: str) -> DataFrame:
    """All versions in a mart, written as ``view=<writer>/load_month=<month>/run=<id>/batch_id=<n>``."""
    return _mart_files(spark, path, name).drop("load_month")


def _mart_files(spark: SparkSession, path: str, name: str) -> DataFrame:
    schema = f"{schemas.MART[name]}, view string, load_month string"
    if not Files(spark, path).exists(path):  # no row of it was written yet
        return spark.createDataFrame([], schema).drop("view")
    return read_batches(spark, path, schema).drop("view")


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """The RAW rows that a view has refused, with the names of the rules they fail in ``failed_rules``."""
    return spark.read.parquet(path).select("rejected.*")


def batch_folders(spark: SparkSession, path: str, after: Mapping[str, int]) -> tuple[list[str], dict[str, int]]:
    """The folders of a mart's batches that are not in `after` (last batch by ``<view>/<run>``) yet, and the last batches
    with them. Names are listed, no file is read."""
    folders, last = [], dict(after)
    for folder in Files(spark, path).matching(f"{path}/view=*/load_month=*/run=*/batch_id=*"):
        view, _, run, batch = (part.partition("=")[2] for part in folder.split("/")[-4:])
        stream = f"{view}/{run}"
        if int(batch) > after.get(stream, -1):
            folders.append(folder)
            last[stream] = max(int(batch), last.get(stream, -1))
    return folders, last


def current_mart(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The rows a report should see.

    Every run loads full snapshots, so the newest load is all that counts, and only the files of its
    month are read. Addresses come from several collections whose loads need not carry the same time;
    they are reduced to the newest row per key over all loads (`streaming.ingest.current_addresses` keeps them so).
    """
    keys = schemas.MART_KEYS[name]
    if name == "address":
        return dedup.latest_by_key(read_mart(spark, path, name), keys)
    newest = dedup.latest_snapshot(_of_newest_month(_mart_files(spark, path, name), path, above=1))
    return dedup.latest_by_key(newest.drop("load_month"), keys)


def snapshot_query(table: str, columns: Sequence[str], load_column: str = "load_date") -> str:
    """Subquery for a JDBC source: projection and newest-load filter run in the database."""
    return (
        f"(SELECT {', '.join(columns)} FROM {table} "
        f"WHERE {load_column} = (SELECT max({load_column}) FROM {table})) AS snapshot"
    )


def read_jdbc_snapshot(
    spark: SparkSession,
    url: str,
    table: str,
    columns: Sequence[str],
    properties: Mapping[str, str],
    split: tuple[str, object, object, int] | None = None,
    load_column: str = "load_date",
) -> DataFrame:
    """Newest load of a mart in a database.

    ``split`` is (numeric or time column, lower bound, upper bound, partitions): without it the whole
    result comes through a single connection and task, which suits small dimension tables only.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=snapshot_query(table, columns, load_column), **properties)
    if split is not None:
        column, low, high, partitions = split
        reader = reader.options(
            partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=str(partitions)
        )
    return reader.load()
