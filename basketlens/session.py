"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import contextvars
import functools
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from basketlens.files import Files

#: Settings the jobs are written for. None of them fixes a partition count: adaptive execution
#: coalesces and splits shuffle partitions from the sizes it measures.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where that costs one more shuffle above the join
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


_SCOPES: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("scratch scopes", default=())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply :data:`SQL_SETTINGS` to a session and return it."""
    for name, value in SQL_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


#: The files of a query's shuffles go when the query ends, not when the driver next collects its garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries made inside leave no shuffle files behind them: for those that are run once, to write their rows."""
    before = spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, before)


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="basketlens-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder for intermediate tables, under the shared folder of the cluster.

    The folder is the session's ``spark.checkpoint.dir``, which every executor can reach. Only a session
    on one machine may do without: a temporary folder is made for it. On a cluster each executor would
    write to its own disk, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _local_folder()
    path = f"{root.rstrip('/')}/basketlens/{label}-{uuid.uuid4().hex}"
    for scope in _SCOPES.get():
        scope.append(path)
    return path


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Scratch folders asked for inside are deleted at the end, also after an error: what is made of them has been written
    by then. Only the names this thread asks for belong to it."""
    folders: list[str] = []
    token = _SCOPES.set((*_SCOPES.get(), folders))
    try:
        yield folders
    finally:
        _SCOPES.reset(token)
        for folder in folders:
            Files(spark, folder).delete(folder)


def staged(df: DataFrame, label: str) -> DataFrame:
    """The rows written to a scratch table and read back: computed once, whatever happens to executors
    later, and of a size the optimizer knows."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
