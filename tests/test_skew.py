"""A key holding a third of the rows: what is split, and what is reduced before the shuffle."""

import random

import pytest
from pyspark.sql import functions as F

from basketlens.operators.fact import enrich_items, wide_fact
from basketlens.operators.features import flags_from_items
from helpers import rows
from test_features import CONFIG, at, item, tables
from workload.single_step import single_step_flags

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def small_limits(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_tables(spark, tmp_path, hot_product=False):
    r = random.Random(7)
    out = []
    for i in range(30_000):
        who = "c0" if i % 3 == 0 else f"c{r.randrange(1, 300)}"
        product = "milk" if hot_product and i % 3 == 1 else r.choice(["apple", "beef", "tea", f"p{r.randrange(200)}"])
        out.append(item(who, f"{who}-{r.randrange(3000)}", product, at(r.randrange(200), r.randrange(24)), str(r.randrange(50, 3000))))
    t = tables(spark, [(f"c{i}", at(10), True) for i in range(320)], out[:1])
    path = str(tmp_path / "purchases")
    spark.createDataFrame(out, t["purchases"].schema).repartition(8).write.parquet(path)
    t["purchases"] = spark.read.parquet(path)
    return t


def executed(df):
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString() or plan.toString()


def test_hot_customer_is_split_in_the_fact(spark, tmp_path, small_limits):
    t = hot_tables(spark, tmp_path)
    fact = wide_fact(**t)
    assert "skew=true" in executed(fact)
    plain = t["customers"].join(t["purchases"], "customer_id", "left")
    assert fact.count() == plain.count()


def test_hot_product_is_split_in_the_lookup(spark, tmp_path, small_limits):
    t = hot_tables(spark, tmp_path, hot_product=True)
    items = enrich_items(t["purchases"], t["products"], t["stores"], t["address"])
    assert "skew=true" in executed(items)


def test_hot_customer_arrives_reduced(spark, tmp_path):
    """The shuffle to customers carries one row per customer and task, however many items there are."""
    t = hot_tables(spark, tmp_path)
    items = enrich_items(t["purchases"], t["products"], t["stores"], t["address"])
    found = flags_from_items(t["customers"], items, CONFIG)
    assert rows(found) == rows(single_step_flags(wide_fact(**t), CONFIG).select(*found.columns))
    plan = executed(found)
    # item rows are aggregated before both exchanges: by purchase, then by customer
    assert plan.count("partial_bit_or") >= 2 and "collect_" not in plan


def test_no_rows_are_lost_to_splitting(spark, tmp_path, small_limits):
    t = hot_tables(spark, tmp_path)
    items = enrich_items(t["purchases"], t["products"], t["stores"], t["address"])
    hot = items.filter("customer_id = 'c0'").agg(F.count("*"), F.sum("total_amount")).first()
    direct = t["purchases"].filter("customer_id = 'c0'").agg(F.count("*"), F.sum("total_amount")).first()
    assert tuple(hot) == tuple(direct) and hot[0] >= 10_000
