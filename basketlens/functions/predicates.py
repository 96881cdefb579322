"""Row checks shared by the mart builders. Each is true or false, never NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from basketlens.functions import casts


def _known(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def non_blank(c: Column) -> Column:
    return c.isNotNull() & _known(c != "")


def is_tax_number(c: Column) -> Column:
    """Exactly ten digits. ``\\z`` rather than ``$``: the latter lets a trailing newline pass."""
    return _known(c.rlike(r"\A[0-9]{10}\z"))


def positive_money(c: Column) -> Column:
    return _known(casts.money(c) > 0)


def positive_real(c: Column) -> Column:
    return _known(casts.real(c) > 0)


def date_before(a: Column, b: Column) -> Column:
    return _known(casts.date(a) < casts.date(b))


def date_not_after(a: Column, b: Column) -> Column:
    return _known(casts.date(a) <= casts.date(b))


def is_true_text(c: Column) -> Column:
    """The text the RAW layer holds for a true flag."""
    return _known(c == "True")
