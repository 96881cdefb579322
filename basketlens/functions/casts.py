"""Text to typed values. Unreadable text gives NULL, it never stops a job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"

# Tried in this order after the ISO forms Spark reads itself.
TIMESTAMP_FORMATS = (
    "dd.MM.yyyy HH:mm:ss",
    "dd.MM.yyyy",
    "yyyy/MM/dd HH:mm:ss",
    "yyyy/MM/dd",
    "dd MMM yyyy HH:mm:ss",
    "dd MMM yyyy",
    "MMM d yyyy HH:mm:ss",
    "MMM d yyyy",
    "yyyyMMddHHmmss",
    "yyyyMMdd",
)


# Digits with at most one point and an exponent; casts would also take NaN, 1d and 1f.
_NUMBER = r"\A\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\s*\z"
# A date with year, month and day; casts would also take 2024, and 12:00 as a time of today.
_DATED = r"\A\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"


def _shaped(c: Column, shape: str) -> Column:
    return F.when(c.rlike(shape), c)


def double(c: Column) -> Column:
    return _shaped(c, _NUMBER).try_cast("double")


def real(c: Column) -> Column:
    return _shaped(c, _NUMBER).try_cast("float")


def money(c: Column) -> Column:
    return c.try_cast(MONEY)


def short(c: Column) -> Column:
    return c.try_cast("smallint")


def boolean(c: Column) -> Column:
    return c.try_cast("boolean")


def date(c: Column) -> Column:
    return _shaped(c, _DATED).try_cast("date")


def timestamp(c: Column) -> Column:
    """Point in time at second precision from ISO text, epoch seconds or milliseconds, or one of the listed formats."""
    seconds = F.when(c.rlike(r"\A[0-9]{9,10}\z"), F.timestamp_seconds(c.try_cast("bigint")))
    epoch = F.coalesce(seconds, F.when(c.rlike(r"\A[0-9]{13}\z"), F.timestamp_millis(c.try_cast("bigint"))))
    listed = [F.try_to_timestamp(c, F.lit(fmt)) for fmt in TIMESTAMP_FORMATS]
    return F.date_trunc("second", F.coalesce(epoch, _shaped(c, _DATED).try_cast("timestamp"), *listed))
