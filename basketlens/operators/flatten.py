"""Nested documents, typed or as JSON text, to flat, all-text RAW rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens import schemas
from basketlens.functions import casts
from basketlens.functions.text import join_list

# Fixed value: the form of record_source.
RECORD_SOURCE = "mongo_db:{database}_{collection}"


def plain_number(text: Column) -> Column:
    """A number written as 1.2E7 in plain digits; any other text, and what has too many digits, as it is."""
    digits = F.rtrim(text.try_cast("decimal(38,18)").cast("string"), F.lit("0"))
    whole = F.concat(digits, F.when(digits.endswith("."), "0").otherwise(""))
    exact = whole.try_cast("double") == text.try_cast("double")
    return F.when(text.rlike("^[-+0-9.]+[eE][-+0-9]+$") & exact & ~whole.rlike("[eE]"), whole).otherwise(text)


def as_text(c: Column, kind: T.DataType) -> Column:
    """A leaf value as RAW text: 'True'/'False' for flags, '|'-joined lists, JSON for lists of objects.

    A missing value stays NULL; written as text it would pass the not-empty checks of the marts.
    """
    if isinstance(kind, T.BooleanType):
        return F.initcap(c.cast("string"))
    if isinstance(kind, T.ArrayType):
        return F.to_json(c) if isinstance(kind.elementType, T.StructType) else join_list(c)
    return plain_number(c.cast("string")) if isinstance(kind, (T.FloatType, T.DoubleType)) else c.cast("string")


def flatten(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every struct path becomes one text column ``a_b_c``; columns in ``keep`` pass unchanged."""

    def leaves(c: Column, name: str, kind: T.DataType):
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                yield from leaves(c.getField(f.name), f"{name}_{f.name}", f.dataType)
        else:
            yield as_text(c, kind).alias(name)

    columns: list[Column] = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        columns.extend([c] if f.name in keep else leaves(c, f.name, f.dataType))
    return df.select(*columns)


def with_lineage(df: DataFrame, loaded_at: dt.datetime, database: str, collection: str) -> DataFrame:
    """One load time per collection and run, and where the rows came from."""
    return df.withColumns(
        {
            "load_date": F.lit(loaded_at.isoformat(timespec="seconds")),
            "record_source": F.lit(RECORD_SOURCE.format(database=database, collection=collection)),
        }
    )


def _named_as_raw(flat: DataFrame, entity: str) -> DataFrame:
    return (
        flat.withColumnsRenamed(schemas.RAW_RENAMES[entity])
        .drop(*schemas.RAW_OMITTED.get(entity, ()))
        .withColumn("load_date", casts.timestamp(F.col("load_date")))
    )


def to_raw(documents: DataFrame, entity: str) -> DataFrame:
    """Published documents of one entity as rows of its RAW table."""
    return _named_as_raw(flatten(documents), entity)


def _is_list(kind: T.DataType) -> bool:
    return isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, T.StructType)


def _as_texts(kind: T.DataType) -> str:
    """The type that takes the leaves of documents as text, and lists, which may be text as well, as they are."""
    if isinstance(kind, T.StructType):
        return f"struct<{', '.join(f'`{f.name}`: {_as_texts(f.dataType)}' for f in kind.fields)}>"
    return "variant" if _is_list(kind) else "string"


def json_to_raw(documents: DataFrame, entity: str, column: str = "document") -> DataFrame:
    """Documents held as a variant as rows of the RAW table of their entity.

    Every value is taken as the text it has in the document, whatever its type there: a fraction where whole numbers
    are usual, or a price in quotes, reaches RAW and is judged by the row checks. Items keep fields nobody lists.
    """

    def leaves(kind: T.StructType, taken: Column, prefix: str):
        for f in kind.fields:
            held, name = taken.getField(f.name), f"{prefix}{f.name}"
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType, held, f"{name}_")
            elif _is_list(f.dataType):
                text = F.try_variant_get(held, "$", "string")
                yield F.coalesce(join_list(F.try_variant_get(held, "$", "array<string>")), text).alias(name)
            elif isinstance(f.dataType, T.BooleanType):
                yield F.initcap(held).alias(name)
            else:
                number = isinstance(f.dataType, T.NumericType)
                yield (plain_number(held) if number else held).alias(name)

    schema = T.StructType.fromDDL(schemas.DOCUMENTS[entity])
    # the fields are taken by one walk over a document: a path for each of them would look for its names anew
    taken = documents.select(F.try_variant_get(column, "$", _as_texts(schema)).alias("taken"))
    return _named_as_raw(taken.select(*leaves(schema, F.col("taken"), "")), entity)
