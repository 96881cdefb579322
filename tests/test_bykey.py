"""Tables stored by a key: joins without a shuffle, frequent keys apart, lost writes."""

import os

import pytest
from pyspark.sql import functions as F

from basketlens.operators.fact import FACT_COLUMNS, stored_fact, wide_fact
from basketlens.sinks.bykey import TableByKey
from helpers import plan_of, rows
from test_features import at, scattered, tables
from test_skew import hot_tables, small_limits  # noqa: F401


def stored(tmp_path, t, buckets=4):
    out = []
    for name in ("customers", "purchases"):
        out.append(TableByKey(str(tmp_path / f"{name}_by_key"), "customer_id", buckets, name == "customers"))
        out[-1].write(t[name])
    return (*out, t["products"], t["stores"], t["address"])


@pytest.mark.parametrize("buckets", [1, 4, 64])
def test_rows_are_those_of_the_wide_fact(spark, tmp_path, buckets):
    # with one bucket no customer is frequent, with 64 all that buy are; c0 to c5 buy, the others don't
    t = tables(spark, [(f"c{i}", at(10 * i), i % 3 > 0) for i in range(45)], scattered(6))
    nobody = t["purchases"].limit(1).withColumn("customer_id", F.lit(None).cast("string"))
    unknown = t["purchases"].limit(1).withColumn("customer_id", F.lit("nobody"))
    t["purchases"] = t["purchases"].unionByName(nobody).unionByName(unknown)
    fact = stored_fact(*stored(tmp_path, t, buckets))
    assert fact.columns == list(FACT_COLUMNS) and rows(fact) == rows(wide_fact(**t))


def test_customers_and_purchases_are_not_shuffled(spark, tmp_path, small_limits):  # noqa: F811
    t = hot_tables(spark, tmp_path)
    args = stored(tmp_path, t, 16)
    purchases = args[1]
    assert rows(purchases.frequent(spark)) == [("c0",)]
    assert purchases.often(spark).count() == 10_000 and purchases.usual(spark).count() == 20_000
    fact = stored_fact(*args)
    assert fact.count() == wide_fact(**t).count()
    usual = args[0].usual(spark).join(purchases.usual(spark), "customer_id", "left")
    plan = plan_of(usual)
    assert "Exchange" not in plan and "Bucketed: true" in plan
    # in the fact no row is dealt by the customer's id, and purchases are read once in each form
    plan = plan_of(fact, "simple")
    assert "hashpartitioning(customer_id" not in plan
    scans = [line for line in plan.splitlines() if "FileScan" in line and "purchase_datetime" in line]
    assert len(scans) == 2 and sum("Bucketed: true" in line for line in scans) == 1


def test_tables_keep_all_rows_and_leave_no_name(spark, tmp_path):
    df = spark.createDataFrame([(k % 7 or None, f"v{k}", [k]) for k in range(50)], "k int, `a b` string, c array<int>")
    table = TableByKey(str(tmp_path / "t"), "k", 3)
    table.write(df)
    assert rows(table.read(spark)) == rows(df) and table.read(spark).schema == df.schema
    table.write(df.limit(0))
    assert table.read(spark).count() == 0
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("basketlens_")]
    with pytest.raises(ValueError, match="3 buckets of k"):
        TableByKey(str(tmp_path / "t"), "k", 4).read(spark)
    os.remove(tmp_path / "t" / "layout.json")  # as after a write that was lost
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        table.read(spark)


def test_different_buckets_are_refused(spark, tmp_path):
    one, two = (TableByKey(str(tmp_path / str(n)), "customer_id", n) for n in (2, 4))
    empty = spark.createDataFrame([], "customer_id string")
    with pytest.raises(ValueError, match="same buckets"):
        stored_fact(one, two, empty, empty, empty)
    with pytest.raises(ValueError, match="unique"):
        stored_fact(two, two, empty, empty, empty)
