"""Personal data: digests, and their use at any depth of a nested document."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.config import MaskingConfig
from basketlens.functions.text import clean_email, clean_phone

#: What the keys begin with wherever they stand, so that plans can hide them.
KEY_MARK = "mask-key:"
_REDACTION = "spark.sql.redaction.string.regex"

#: field name -> cleaning applied before the digest
PERSONAL_FIELDS: dict[str, Callable[[Column], Column]] = {"phone": clean_phone, "email": clean_email}


def masking_keys(secret: str) -> tuple[str, str]:
    """The inner and the outer key derived from a secret, which itself enters no plan."""
    return tuple(KEY_MARK + hashlib.sha256(f"{use}:{secret}".encode()).hexdigest() for use in ("inner", "outer"))


def keyed_digest(c: Column, secret: str) -> Column:
    """Nested digest: unlike that of key and value alone, it cannot be extended."""
    inner, outer = masking_keys(secret)
    return F.sha2(F.concat(F.lit(outer), F.sha2(F.concat(F.lit(inner), c), 256)), 256)


def random_digest(c: Column) -> Column:
    """md5 of the value and a salt nobody keeps: the token cannot be traced back or joined.

    The salt comes from the secure generator of the JVM; a seeded function would put its seed into the plan.
    """
    return F.md5(F.concat(c, F.expr("reflect('java.util.UUID', 'randomUUID')")))


def hide_keys(spark: SparkSession) -> None:
    """Has Spark leave masking keys out of plan texts (explain, user interface, event log)."""
    pattern, known = f"{KEY_MARK}[0-9a-f]+", spark.conf.get(_REDACTION, None)
    if pattern not in (known or ""):
        spark.conf.set(_REDACTION, f"{known}|{pattern}" if known else pattern)


def digest(c: Column, config: MaskingConfig) -> Column:
    """Digest of a cleaned value; NULL (for example an invalid phone number) stays NULL."""
    return random_digest(c) if config.mode == "random" else keyed_digest(c, config.secret)


def _touches(data_type: T.DataType) -> bool:
    """Whether anything inside the type has to be rewritten."""
    if isinstance(data_type, T.StructType):
        return any(
            f.name == "_id"
            or (f.name in PERSONAL_FIELDS and isinstance(f.dataType, T.StringType))
            or _touches(f.dataType)
            for f in data_type.fields
        )
    return isinstance(data_type, T.ArrayType) and isinstance(data_type.elementType, T.StructType) and _touches(
        data_type.elementType
    )


def _rewrite(c: Column, field: T.StructField, config: MaskingConfig) -> Column:
    kind = field.dataType
    if field.name == "_id":
        return c.cast("string")
    if field.name in PERSONAL_FIELDS and isinstance(kind, T.StringType):
        return digest(PERSONAL_FIELDS[field.name](c), config)
    if not _touches(kind):
        return c
    if isinstance(kind, T.StructType):
        return _rewrite_struct(c, kind, config)
    return F.transform(c, lambda element: _rewrite_struct(element, kind.elementType, config))


def _rewrite_struct(c: Column, kind: T.StructType, config: MaskingConfig) -> Column:
    fields = [_rewrite(c.getField(f.name), f, config).alias(f.name) for f in kind.fields]
    return F.when(c.isNotNull(), F.struct(*fields))


def mask_documents(df: DataFrame, config: MaskingConfig) -> DataFrame:
    """Replace phone and email fields wherever they stand: top level, nested objects, lists of objects.

    The schema is walked once on the driver and gives one projection, so the work per row stays in
    generated code.
    """
    hide_keys(df.sparkSession)
    return df.select(*[_rewrite(F.col(f"`{f.name}`"), f, config).alias(f.name) for f in df.schema.fields])
