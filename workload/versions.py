"""Loads, versions, duplicates. Line items serve as versions of (order, line) loaded on their ship date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.operators import dedup, quality
from basketlens.session import scratch_path
from basketlens.sinks.state import KeyedTable
from workload.adapter import AS_OF, Supplied
from workload.case import Case

KEY = ("l_orderkey", "l_linenumber")


def _versions(s: Supplied) -> DataFrame:
    return s.table("lineitem").withColumnRenamed("l_shipdate", "load_date")


VERSIONS = "SELECT * EXCLUDE (l_shipdate), l_shipdate AS load_date FROM lineitem"
TIES = ", ".join(
    f"{c} DESC NULLS LAST"
    for c in (
        "load_date l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus".split()
    )
)


def _latest_sql(source: str) -> str:
    return (
        f"SELECT * EXCLUDE (version) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
        f"ORDER BY {TIES}) AS version FROM ({source})) WHERE version = 1"
    )


NEWEST = f"SELECT * FROM ({VERSIONS}) WHERE load_date = (SELECT max(l_shipdate) FROM lineitem)"

def _merged(s: Supplied) -> DataFrame:
    """Duplicates over all loads from counts of each load (those that shipped in one year): a load brings its own keys only,
    and one that comes twice counts once."""
    counts = KeyedTable(
        scratch_path(s.spark, "counts"), "l_orderkey bigint, l_linenumber int, copies bigint", KEY, lambda df: quality.merged_counts(df, KEY)
    )
    items = s.table("lineitem")
    year = F.year("l_shipdate")
    first, last = items.select(F.min(year), F.max(year)).first()
    middle = (first + last) // 2
    loads = [items.filter(year <= middle), items.filter(year > middle)]
    for number in (0, 1, 0, 1):
        counts.upsert(quality.key_counts(loads[number], KEY), {"year": number})
    return counts.read(s.spark).filter("copies > 1")


CASES = [
    Case("latest_snapshot", lambda s: dedup.latest_snapshot(_versions(s)), NEWEST),
    Case("latest_by_key", lambda s: dedup.latest_by_key(_versions(s), KEY), _latest_sql(VERSIONS)),
    Case("current_rows", lambda s: dedup.current_rows(_versions(s), KEY), _latest_sql(NEWEST)),
    Case(
        "retention_filter",
        lambda s: dedup.retained(_versions(s), AS_OF),
        f"SELECT * FROM ({VERSIONS}) WHERE load_date > DATE '2001-08-02' - INTERVAL '1' YEAR",
    ),
    Case(
        "duplicate_keys",
        lambda s: quality.duplicate_keys(s.table("lineitem"), KEY),
        "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem "
        "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
    ),
    Case(
        "duplicate_keys_merged",
        _merged,
        "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem "
        "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
    ),
    Case(
        "duplicate_summary",
        lambda s: quality.duplicate_summary(s.table("lineitem"), KEY),
        "SELECT count(*) AS duplicate_keys, CAST(coalesce(sum(copies - 1), 0) AS BIGINT) AS surplus_rows FROM ("
        "SELECT count(*) AS copies FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)",
    ),
    Case(
        "load_counts",
        lambda s: quality.load_counts(
            {
                "customers": s.table("customer"),
                "stores": s.table("supplier"),
                "products": s.table("part"),
                "purchases": s.table("orders"),
                "refunds": s.table("orders").filter(F.col("o_orderstatus") == "none"),
            }
        ),
        """SELECT 'customers' AS collection, count(*) AS documents FROM customer
           UNION ALL SELECT 'stores', count(*) FROM supplier UNION ALL SELECT 'products', count(*) FROM part
           UNION ALL SELECT 'purchases', count(*) FROM orders
           UNION ALL SELECT 'refunds', 0""",
    ),
]
