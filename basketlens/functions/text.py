"""Text cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two sets of characters stripped one after the other from the left of a category
# name (emoji, comma and space, each set taken as single characters).
CATEGORY_PREFIXES = ("🥖, 🥩, 🥛", "🍏 ,🥦")


def normalize(c: Column) -> Column:
    """Outer spaces off, lower case (any alphabet)."""
    return F.lower(F.trim(c))


def strip_leading(c: Column, *charsets: str) -> Column:
    """Remove leading characters that occur in each of the sets, set after set."""
    for charset in charsets:
        c = F.ltrim(c, F.lit(charset))
    return c


def category(c: Column) -> Column:
    """Category name without its emoji, lower case."""
    return F.lower(strip_leading(c, *CATEGORY_PREFIXES))


def split_list(c: Column, separator: str = "|") -> Column:
    """Delimited text to array; the separator is literal text, not a pattern."""
    return F.split(c, r"\Q" + separator + r"\E")


def join_list(c: Column, separator: str = "|") -> Column:
    return F.array_join(c, separator)


def clean_phone(c: Column) -> Column:
    """Eleven digits with an optional plus, written without punctuation; ``+7`` becomes ``8``.

    Anything else is no phone number and gives NULL. Other country codes keep their plus.
    """
    bare = F.translate(c, " ()-", "")
    return F.when(bare.rlike(r"\A\+?[0-9]{11}\z"), F.regexp_replace(bare, r"\A\+7", "8"))


def clean_email(c: Column) -> Column:
    """Spaces out, lower case; empty text gives NULL."""
    return F.nullif(F.lower(F.translate(c, " ", "")), F.lit(""))
