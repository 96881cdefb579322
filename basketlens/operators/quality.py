"""Duplicate checks, load counts and rejected rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with the number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key: what a load adds to the counts of all loads."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies"))


def merged_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts of several loads as one."""
    return df.groupBy(*keys).agg(F.sum("copies").alias("copies"))


def duplicate_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: number of duplicated keys and of rows beyond the first per key."""
    return duplicate_keys(df, keys).agg(
        F.count("*").alias("duplicate_keys"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("surplus_rows"),
    )


def load_counts(collections: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per collection; an empty collection shows up with zero."""
    counts = [
        df.agg(F.count("*").alias("documents")).select(F.lit(name).alias("collection"), "documents")
        for name, df in collections.items()
    ]
    result = counts[0]
    for part in counts[1:]:
        result = result.unionByName(part)
    return result


def counted(df: DataFrame, seen: Observation) -> DataFrame:
    """df, whose rows are counted into `seen` by the job that writes them."""
    return df.observe(seen, F.count(F.lit(1)).alias("rows"))


def rows_seen(seen: Observation) -> int:
    """The count of a job that has ended; waits for nothing else."""
    return seen.get.get("rows") or 0


def accepted(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that pass every rule."""
    for rule in rules.values():
        df = df.filter(rule)
    return df


def failed_rules(rules: Mapping[str, Column]) -> Column:
    """The names of the rules that a row fails; one that can't be told fails."""
    return F.array_compact(F.array(*[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]))


def rejected(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that fail a rule, with the names of the rules they fail in ``failed_rules``."""
    return df.withColumn("failed_rules", failed_rules(rules)).filter(F.size("failed_rules") > 0)


def rejection_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """How many rows fail each rule. Rules no row fails are not listed."""
    return (
        rejected(df, rules)
        .select(F.explode("failed_rules").alias("rule"))
        .groupBy("rule")
        .agg(F.count("*").alias("rejected_rows"))
    )
