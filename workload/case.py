"""What a registered query is."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from workload.adapter import Supplied, domain_sql


@dataclass(frozen=True)
class Case:
    """A query over the supplied tables and, where SQL can say it, the SQL giving the same rows."""

    name: str
    run: Callable[[Supplied], DataFrame]
    sql: str | None = None


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the supplied tables have them."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def with_domain(*names: str, body: str) -> str:
    """SQL with the named domain tables as common table expressions."""
    tables = ", ".join(f"{name} AS ({domain_sql(name)})" for name in names)
    return f"WITH {tables} {body}"


def sql_key(*columns: str) -> str:
    """The surrogate key of the library, in SQL."""
    text = ", ".join(f"coalesce({c}, '')" for c in columns)
    return f"CAST('0x' || substr(md5(concat_ws(chr(31), {text})), 1, 15) AS BIGINT)"


def sql_normal(*columns: str) -> list[str]:
    return [f"lower(trim({c}))" for c in columns]


def sql_filled(*columns: str) -> str:
    return " AND ".join(f"({c} IS NOT NULL AND {c} <> '')" for c in columns)


def sql_category(column: str) -> str:
    # fixed values: the characters before category names
    return f"lower(ltrim(ltrim({column}, '🥖, 🥩, 🥛'), '🍏 ,🥦'))"
