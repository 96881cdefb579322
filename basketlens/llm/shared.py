"""What the operators of this package have in common."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def whole_text(column: str = "text") -> Column:
    """The text as it is; a null text is an empty one."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def ascii_lower(column: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(column, _UPPER, _LOWER)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names, close to the given ones, that no column of df has."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def ship(spark: SparkSession) -> None:
    """Lets the Python workers of every executor import this package, installed there or not."""
    context = spark.sparkContext
    if getattr(context, "_basketlens_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="basketlens-code-")) / "basketlens.zip"
    with zipfile.ZipFile(archive, "w") as target:
        for source in sorted(package.rglob("*.py")):
            target.write(source, source.relative_to(package.parent).as_posix())
    context.addPyFile(str(archive))
    context._basketlens_shipped = True
