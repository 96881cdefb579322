"""Flags from day rows against flags from items."""

import datetime as dt
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from basketlens.config import CategoryRoles, FeatureConfig
from basketlens.operators import days
from basketlens.operators.features import flags_from_items
from helpers import plan_of, rows

CONFIG = FeatureConfig(
    as_of=dt.date(2024, 5, 1), roles=CategoryRoles("dairy", "fruit", "veg", "meat", "bread"), bulk_above=60, low_below=40, spender_from=90
)
ITEMS = (
    "customer_id string, purchase_id string, product_id string, store_id string, city string, category_name string, "
    "is_organic boolean, is_delivery boolean, payment_method string, total_amount decimal(18,2), "
    "purchase_datetime timestamp, load_date timestamp"
)


def bought(seed, number=400):
    rng = random.Random(seed)
    out = []
    for i in range(number):
        customer = rng.choice(["hot"] * 4 + [f"c{k}" for k in range(25)])
        when = dt.datetime(2024, 4, 30, 12) - dt.timedelta(days=rng.choice([0, 1, 5, 7, 13, 14, 15, 29, 30, 31, 89, 91, 200]), hours=rng.randint(-11, 11))
        amount, paid, store = rng.randint(1, 100), rng.choice(["cash", "card", None]), rng.choice(["s1", "s2", None])
        for _ in range(rng.randint(1, 4)):
            kind = rng.choice(["dairy", "fruit", "veg", "meat", "bread", "x", "y", None])
            product = rng.choice([f"p{k}" for k in range(9)] + [None])
            out.append((customer, f"o{seed}-{i}", product, store, {"s1": "A", "s2": "B"}.get(store), kind, rng.random() < 0.1, rng.random() < 0.1, paid, amount, when, dt.datetime(2024, 5, 1)))
    return out


@pytest.fixture(scope="module")
def people(spark):
    names = [(c, dt.datetime(2024, 4, 10), k % 2 == 0) for k, c in enumerate(["hot", "nobody", *[f"c{k}" for k in range(25)]])]
    return spark.createDataFrame(names, "customer_id string, registration_date timestamp, is_loyalty_member boolean")


def typed(spark, values):
    return spark.createDataFrame([tuple(v) for v in values], ITEMS.replace("decimal(18,2)", "int")).withColumn("total_amount", F.col("total_amount").cast("decimal(18,2)"))


def test_flags_of_any_day_and_reading(spark, people, tmp_path):
    items = typed(spark, bought(1)).cache()
    table = days.table(str(tmp_path / "days"), 4)
    early = F.to_date("purchase_datetime") < F.lit(dt.date(2024, 4, 17))
    for number in (0, 1, 0):
        table.upsert(days.day_rows(items.filter(~early if number else early), CONFIG), {"loads": number})
    kept = table.read(spark)
    for config in (CONFIG, replace(CONFIG, as_of=dt.date(2024, 4, 18)), replace(CONFIG, basket_grain="purchase", week_days=14), replace(CONFIG, fruit_counts="category")):
        assert rows(days.flags_from_days(people, kept, config)) == rows(flags_from_items(people, items, config))
    some = ("no_purchases", "varied_shopper")
    assert rows(days.flags_from_days(people, kept, CONFIG, some)) == rows(flags_from_items(people, items, CONFIG, some))


def test_a_day_that_comes_again_replaces_itself(spark, people, tmp_path):
    first, later = bought(2, 60), bought(2, 60)
    day = first[0][10].date()
    later = [(*r[:9], 95, r[10], dt.datetime(2024, 5, 2)) for r in later if r[10].date() == day]
    table = days.table(str(tmp_path / "days"), 4)
    table.upsert(days.day_rows(typed(spark, first), CONFIG), {"loads": 0})
    table.upsert(days.day_rows(typed(spark, later), CONFIG), {"loads": 1})
    items = typed(spark, [r for r in first if r[10].date() != day] + later)
    assert rows(days.flags_from_days(people, table.read(spark), CONFIG)) == rows(flags_from_items(people, items, CONFIG))


def test_no_items_and_what_days_do_not_hold(spark, people):
    none = days.day_rows(typed(spark, []), CONFIG)
    found = days.flags_from_days(people, none, CONFIG)
    assert rows(found) == rows(flags_from_items(people, typed(spark, []), CONFIG))
    with pytest.raises(ValueError, match="distinct_city"):
        days.flags_from_days(people, none, replace(CONFIG, cities=3))


def test_items_are_reduced_before_they_are_shuffled(spark):
    plan = plan_of(days.day_rows(typed(spark, bought(3, 5)), CONFIG), "simple")
    assert "partial_bit_or" in plan and "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_days_and_their_categories_meet_where_they_were_grouped(spark):
    items = typed(spark, bought(4, 40))
    plan = plan_of(days.day_rows(items, CONFIG), "simple")
    # baskets, days, category lists; a join that dealt both sides out anew would have more
    assert plan.count("Exchange hashpartitioning") == 3


def test_days_without_customer_or_date_keep_their_categories(spark):
    day, load = dt.datetime(2024, 4, 30, 12), dt.datetime(2024, 5, 1)
    who = [(None, day, "a"), (None, day, "a"), (None, day, "b"), ("", day, "c"), ("=", day, "d"), ("c1", None, "e"), (None, None, None)]
    items = typed(spark, [(c, "o", "p", "s", "A", kind, False, False, "cash", 5, when, load) for c, when, kind in who])
    found = days.day_rows(items, CONFIG)
    of = {(r.customer_id, r.day): (r.categories, r["items"]) for r in found.collect()}
    assert found.count() == 5 and of == {
        (None, day.date()): (["a", "b"], 3), ("", day.date()): (["c"], 1), ("=", day.date()): (["d"], 1),
        ("c1", None): (["e"], 1), (None, None): ([], 1),
    }
