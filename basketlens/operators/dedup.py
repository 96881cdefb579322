"""Versions of a row: newest per key, latest load, retention."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.session import staged


def latest_by_key(
    df: DataFrame, keys: Sequence[str], version: str = "load_date", tie_breakers: Sequence[str] | None = None
) -> DataFrame:
    """One row per key, the one with the greatest version.

    Equal versions are settled by the remaining orderable columns (greatest first), so the result does
    not depend on the order rows arrive in. Because the filter asks for rank one, Spark keeps a single
    row per key and map task before the shuffle (WindowGroupLimit): a key holding a large part of the
    table does not end up whole in one task. Rows are sorted by a hash of the keys first: one number tells most of
    them apart, where the beginnings of keys are often alike.
    """
    if tie_breakers is None:
        unorderable = (T.MapType, T.VariantType)
        tie_breakers = [
            f.name
            for f in df.schema.fields
            if f.name not in keys and f.name != version and not isinstance(f.dataType, unorderable)
        ]
    order = [F.col(f"`{c}`").desc_nulls_last() for c in (version, *tie_breakers)]
    by = [F.col(f"`{k}`") for k in keys]
    rank = F.row_number().over(Window.partitionBy(F.xxhash64(*by), *by).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def latest_snapshot(df: DataFrame, load_column: str = "load_date", partition_column: str | None = None) -> DataFrame:
    """Rows of the newest load.

    The newest load is a scalar subquery over the one column. With ``partition_column`` (for example
    ``load_month`` of a monthly table) that subquery and the outer scan read the newest partition only.
    """
    if partition_column is not None:
        newest = df.select(F.max(partition_column)).scalar()
        df = df.filter(F.col(partition_column) == newest)
    return df.filter(F.col(load_column) == df.select(F.max(load_column)).scalar())


def current_rows(df: DataFrame, keys: Sequence[str], version: str = "load_date") -> DataFrame:
    """What a reader of a mart wants: the newest load, one row per key.

    A load that wrote the same key twice would otherwise still count it twice.
    """
    return latest_by_key(latest_snapshot(df, version), keys, version)


def current_rows_once(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], version: str = "load_date"
) -> DataFrame:
    """Some columns of `current_rows`, of rows that are dear to compute (a view over RAW rows): in one pass over them.

    To look for the newest load first would compute every row twice. Here versions are settled over all loads, which
    leaves the same row to a key of the newest load, and are kept; the newest load is looked up in what was kept.
    """
    settled = latest_by_key(df, keys, version).select(*dict.fromkeys((*columns, version)))
    return latest_snapshot(staged(settled, "settled"), version).select(*columns)


def retained(
    df: DataFrame,
    as_of: dt.date | dt.datetime | Column,
    column: str = "load_date",
    months: int = 12,
    partition_column: str | None = None,
) -> DataFrame:
    """Rows whose load is less than the retention period old.

    The bound is a constant, so it reaches the scan as a pushed filter; with ``partition_column`` (the
    ``load_month`` of a monthly table) expired months are not read at all.
    """
    bound = as_of if isinstance(as_of, Column) else F.lit(as_of)
    bound = bound - F.make_ym_interval(F.lit(0), F.lit(months))
    if partition_column is not None:
        df = df.filter(F.col(partition_column) >= F.date_format(bound, "yyyyMM"))
    return df.filter(F.col(column) > bound)
