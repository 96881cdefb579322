"""Removal of expired loads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from basketlens.files import Files
from basketlens.operators.dedup import retained
from basketlens.sources.tables import month_folders


def first_kept(as_of: dt.date, months: int = 12) -> str:
    """The oldest load month that still holds a row less than `months` old, as '202405'."""
    number = as_of.year * 12 + as_of.month - 1 - months
    return f"{number // 12:04d}{number % 12 + 1:02d}"


def expire(spark: SparkSession, path: str, as_of: dt.date, months: int = 12, above: int = 0) -> list[str]:
    """Delete the folders of months of which every row has expired; returns them.

    A table goes by load month, so no file is read or rewritten. Rows that expire within the first month kept are left
    to `rewrite_boundary`, or to the filter of readers (`operators.dedup.retained`) until their month is over. Repeating
    it after a failure deletes what is left.
    """
    least, deleted = first_kept(as_of, months), []
    for month, folders in sorted(month_folders(spark, path, above).items()):
        for folder in folders if month < least else ():
            Files(spark, folder).delete(folder)
            deleted.append(folder)
    return deleted


def rewrite_boundary(
    spark: SparkSession, path: str, as_of: dt.date, months: int = 12, above: int = 0, column: str = "load_date"
) -> list[str]:
    """Rewrite the first month kept without its expired rows; returns the folders that were exchanged.

    What stays of a folder is written next to the table, in a folder that readers pass over, and only then exchanged for
    it by two renames. A run that is lost on the way is completed by the next: a folder that was taken away comes back as
    the finished new one, an unfinished new one is written again. Folders without expired rows are left alone, which the
    bounds in their files tell.
    """
    files, least = Files(spark, path), first_kept(as_of, months)
    finish_exchanges(spark, path, above)
    bound = F.lit(as_of) - F.make_ym_interval(F.lit(0), F.lit(months))
    exchanged = []
    for folder in month_folders(spark, path, above).get(least, ()):
        rows = spark.read.parquet(folder)
        if rows.filter(F.col(column) <= bound).isEmpty():
            continue
        name = _name(folder, above)
        retained(rows, as_of, column, months).write.mode("overwrite").parquet(f"{path}/_new/{name}")
        files.move(folder, f"{path}/_old/{name}")
        _put_in_place(files, path, name)
        exchanged.append(folder)
    _clear(files, path)
    return exchanged


def _name(folder: str, above: int) -> str:
    """A month's folder as it is called below its table."""
    return "/".join(folder.rstrip("/").split("/")[-above - 1 :])


def _put_in_place(files: Files, path: str, name: str) -> None:
    files.move(f"{path}/_new/{name}", f"{path}/{name}")
    files.delete(f"{path}/_old/{name}")


def _clear(files: Files, path: str) -> None:
    for folder in ("_new", "_old"):
        files.delete(f"{path}/{folder}")


def finish_exchanges(spark: SparkSession, path: str, above: int = 0) -> list[str]:
    """Completes the exchanges of folders that an earlier run has begun; returns their names below the table."""
    files, finished = Files(spark, path), []
    for old in files.matching(f"{path}/_old/{'*/' * above}load_month=*"):
        name = _name(old, above)
        if files.exists(f"{path}/{name}"):
            files.delete(old)  # only this was left to do
        else:
            _put_in_place(files, path, name)
        finished.append(name)
    _clear(files, path)
    return finished
