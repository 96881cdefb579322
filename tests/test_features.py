import datetime as dt
import random
import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from basketlens.config import FeatureConfig
from basketlens.operators.fact import FACT_COLUMNS, enrich_items, wide_fact
from basketlens.operators.features import (
    FAMILIES,
    FLAG_NAMES,
    customer_features,
    customer_profile,
    family,
    flags_from_items,
)
from helpers import plan_of, rows
from workload.single_step import single_step_flags

AS_OF = dt.date(2024, 6, 30)
CONFIG = FeatureConfig(as_of=AS_OF)
R = CONFIG.roles
PRODUCTS = [
    ("milk", R.dairy, False),
    ("apple", R.fruit, True),
    ("carrot", R.vegetables, False),
    ("beef", R.meat, False),
    ("bread", R.bakery, False),
    ("tea", "чай", False),
]
STORES = [("s1", 1), ("s2", 2), ("s3", 1), ("s4", 99)]
ADDRESS = [(1, "омск"), (2, "томск")]

CUSTOMER_DDL = "customer_id string, registration_date timestamp_ntz, is_loyalty_member boolean"
PURCHASE_DDL = (
    "purchase_id string, store_id string, customer_id string, product_id string, total_amount decimal(18,2), "
    "payment_method string, is_delivery boolean, purchase_datetime timestamp_ntz, load_date timestamp_ntz"
)


def at(days_ago, hour=11, minute=0):
    return dt.datetime.combine(AS_OF - dt.timedelta(days=days_ago), dt.time(hour, minute))


def item(customer, purchase, product, when, total="500", store="s1", pay="other", delivery=False):
    from decimal import Decimal

    total = None if total is None else Decimal(total)
    return (purchase, store, customer, product, total, pay, delivery, when, at(0))


def tables(spark, customers, items):
    return {
        "customers": spark.createDataFrame(customers, CUSTOMER_DDL),
        "purchases": spark.createDataFrame(items, PURCHASE_DDL),
        "products": spark.createDataFrame(PRODUCTS, "product_id string, category_name string, is_organic boolean"),
        "stores": spark.createDataFrame(STORES, "store_id string, address_id bigint"),
        "address": spark.createDataFrame(ADDRESS, "address_id bigint, city string"),
    }


def flags(spark, items, customers=None, config=CONFIG):
    """{customer: set of flags that are true}"""
    customers = customers or [(c, at(400), True) for c in sorted({i[2] for i in items})]
    found = customer_features(**tables(spark, customers, items), config=config)
    assert tuple(found.columns) == ("customer_id", *FLAG_NAMES)
    return {r["customer_id"]: {n for n in FLAG_NAMES if r[n]} for r in found.collect()}


def test_thirty_flags_in_seven_families():
    assert len(FLAG_NAMES) == 30 and len(set(FLAG_NAMES)) == 30
    assert sorted(n for f in FAMILIES for n in family(f)) == sorted(FLAG_NAMES)


def test_customer_without_purchases(spark):
    found = flags(spark, [item("a", "p", "tea", at(300))], [("a", at(400), True), ("b", at(400), True)])
    assert found["b"] == {"no_purchases", "not_bought_veggies_14d", "vegetarian_profile"}
    assert "no_purchases" not in found["a"]


def test_day_windows_include_midnight_of_their_first_day(spark):
    edge = {7: "beef", 14: "apple", 30: "milk", 90: "beef"}
    items = []
    for days, product in edge.items():
        midnight = at(days, 0)
        items.append(item(f"in{days}", f"in{days}", product, midnight))
        items.append(item(f"out{days}", f"out{days}", product, midnight - dt.timedelta(seconds=1)))
    items.append(item("veg-in", "v1", "carrot", at(14, 0)))
    items.append(item("veg-out", "v2", "carrot", at(14, 0) - dt.timedelta(seconds=1)))
    found = flags(spark, items)
    assert "bought_meat_last_week" in found["in7"] and "bought_meat_last_week" not in found["out7"]
    assert "bought_fruits_last_14d" in found["in14"] and "bought_fruits_last_14d" not in found["out14"]
    assert "bought_milk_last_30d" in found["in30"] and "bought_milk_last_30d" not in found["out30"]
    assert "vegetarian_profile" not in found["in90"] and "vegetarian_profile" in found["out90"]
    assert "not_bought_veggies_14d" not in found["veg-in"] and "not_bought_veggies_14d" in found["veg-out"]
    assert "inactive_14_30" not in found["in14"] and "inactive_14_30" in found["out14"]
    assert "inactive_14_30" in found["in30"] and "inactive_14_30" not in found["out30"]


def test_registration_window(spark):
    items = [item(c, c, "tea", at(300)) for c in ("a", "b")]
    found = flags(spark, items, [("a", at(30, 0), True), ("b", at(31, 23), True)])
    assert "new_customer" in found["a"] and "new_customer" not in found["b"]


def test_hours(spark):
    found = flags(spark, [item(f"h{h}", f"h{h}", "tea", at(300, h, 30)) for h in (9, 10, 11, 12, 14, 15, 20, 21)])
    by_flag = {n: {c for c in found if n in found[c]} for n in ("morning_shopper", "early_bird", "night_shopper")}
    assert by_flag == {"morning_shopper": {"h9"}, "early_bird": {"h12", "h14"}, "night_shopper": {"h21"}}


def purchases(customer, number, **of_kind):
    """``number`` single-item purchases; ``of_kind`` gives (count, changes) for the first of them."""
    out = []
    for i in range(number):
        changes = {"when": at(300 + 7 * i), "product": "tea"}
        for count, change in of_kind.values():
            if i < count:
                changes |= change
        out.append(item(customer, f"{customer}-{i}", **changes))
    return out


def test_shares_at_their_bounds(spark):
    sat = next(at(d) for d in range(300, 307) if at(d).weekday() == 5)
    sun = next(at(d) for d in range(300, 307) if at(d).weekday() == 6)
    mon = next(at(d) for d in range(300, 307) if at(d).weekday() == 0)

    def mixed(customer, weekend):
        days = [sat if i % 2 else sun for i in range(weekend)] + [mon] * (10 - weekend)
        return [item(customer, f"{customer}{i}", "tea", day) for i, day in enumerate(days)]

    items = (
        purchases("cash7", 10, a=(7, {"pay": "cash"}))
        + purchases("cash6", 10, a=(6, {"pay": "cash"}))
        + purchases("card7", 10, a=(7, {"pay": "card"}))
        + mixed("w6", 6)
        + mixed("w5", 5)
        + mixed("w4", 4)
    )
    found = flags(spark, items)
    assert "prefers_cash" in found["cash7"] and "prefers_cash" not in found["cash6"]
    assert "prefers_card" in found["card7"] and "prefers_card" not in found["cash7"]
    assert "weekend_shopper" in found["w6"] and "weekend_shopper" not in found["w5"]
    assert "weekday_shopper" in found["w4"] and "weekday_shopper" not in found["w5"]


def test_baskets(spark):
    def basket(customer, purchase, size):
        return [item(customer, purchase, p[0], at(300)) for p in PRODUCTS[:size]]

    items = basket("half", "h1", 1) + basket("half", "h2", 2)
    items += basket("third", "t1", 1) + basket("third", "t2", 2) + basket("third", "t3", 3)
    items += basket("four", "f1", 3) + basket("four", "f2", 5)
    items += basket("less", "l1", 3) + basket("less", "l2", 4)
    found = flags(spark, items)
    assert "single_item_buyer" in found["half"] and "single_item_buyer" not in found["third"]
    assert "family_shopper" in found["four"] and "family_shopper" not in found["less"]
    assert "varied_shopper" in found["four"] and "varied_shopper" not in found["third"]


def test_amounts(spark):
    items = [
        item("1000", "a", "tea", at(300), "1000.00"),
        item("1000.01", "b", "tea", at(300), "1000.01"),
        item("200", "c", "tea", at(300), "200.00"),
        item("199.99", "d", "tea", at(300), "199.99"),
        item("2000", "e", "tea", at(7, 0), "2000"),
        item("1999", "f", "tea", at(7, 0), "1999.99"),
        item("old", "g", "tea", at(8), "5000"),
        item("none", "h", "tea", at(300), None),
    ]
    # three items of a cheap purchase against one of a dear one: mean over items 875, over purchases 1250
    items += [item("mix", "m1", p, at(300), "500") for p in ("tea", "milk", "beef")]
    items += [item("mix", "m2", "tea", at(300), "2000")]
    found = flags(spark, items)
    bulk = {c for c in found if "bulk_buyer" in found[c]}
    assert bulk == {"1000.01", "2000", "1999", "old"}
    assert {c for c in found if "low_cost_buyer" in found[c]} == {"199.99"}
    assert {c for c in found if "recent_high_spender" in found[c]} == {"2000"}
    by_purchase = flags(spark, items, config=replace(CONFIG, basket_grain="purchase"))
    assert "bulk_buyer" in by_purchase["mix"]


def test_lifecycle(spark):
    items = purchases("two", 2) + purchases("three", 3) + purchases("guest", 3)
    items += [item("busy", f"b{i}", "tea", at(5)) for i in range(3)] + [item("calm", f"c{i}", "tea", at(5)) for i in range(2)]
    customers = [(c, at(400), c != "guest") for c in ("two", "three", "guest", "busy", "calm")]
    found = flags(spark, items, customers)
    assert {c for c in found if "loyal_customer" in found[c]} == {"three", "busy"}
    assert {c for c in found if "recurrent_buyer" in found[c]} == {"busy"}


def test_stores_and_cities(spark):
    items = [item("one", "a", "tea", at(300)), item("one", "b", "tea", at(300))]
    items += [item("same city", "c", "tea", at(300), store="s1"), item("same city", "d", "tea", at(300), store="s3")]
    items += [item("cities", "e", "tea", at(300), store="s1"), item("cities", "f", "tea", at(300), store="s2")]
    items += [item("unknown", "g", "tea", at(300), store="s4"), item("unknown", "h", "tea", at(300), store="nowhere")]
    items += [item("no store", "i", "tea", at(300), store=None)]
    found = flags(spark, items)
    assert {c for c in found if "store_loyal" in found[c]} == {"one"}
    assert {c for c in found if "switching_loyal" in found[c]} == {"same city", "cities", "unknown"}
    assert {c for c in found if "multycity_buyer" in found[c]} == {"cities"}


def test_fruit_lover_as_intended_and_as_written(spark):
    items = [item("a", f"p{i}", "apple", at(3)) for i in range(3)] + [item("b", "q", "apple", at(3))] * 3
    assert {c for c, f in flags(spark, items).items() if "fruit_lover" in f} == {"a"}
    written = flags(spark, items, config=replace(CONFIG, fruit_counts="category"))
    assert not any("fruit_lover" in f for f in written.values())


def test_purchases_of_unknown_customers_are_left_out(spark):
    found = flags(spark, [item("a", "p", "tea", at(3)), item("ghost", "q", "tea", at(3))], [("a", at(9), True)])
    assert set(found) == {"a"}


def scattered(seed, customers=40, number=1500, hot=True):
    """Random items: headers vary within a purchase, ids are missing now and then, one customer holds a third."""
    r = random.Random(seed)
    out = []
    for i in range(number):
        who = "c0" if hot and i % 3 == 0 else f"c{r.randrange(1, customers)}"
        out.append(
            item(
                who,
                None if r.random() < 0.02 else f"p{who}-{r.randrange(1, 12)}",
                None if r.random() < 0.03 else r.choice(PRODUCTS)[0] if r.random() > 0.05 else "unknown",
                at(r.choice([0, 3, 7, 13, 14, 15, 29, 30, 31, 89, 90, 91, 200]), r.randrange(24)),
                None if r.random() < 0.03 else str(r.choice([100, 199.99, 250, 900, 1000, 1500, 2000, 4000])),
                r.choice(["s1", "s2", "s3", "s4", None]) if r.random() < 0.4 else "s1",
                r.choice(["cash", "card", "cash", None]),
                r.choice([True, False, None]),
            )
        )
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_staged_equals_single_step(spark, seed):
    customers = [(f"c{i}", at(10 * i), i % 3 > 0) for i in range(45)]
    t = tables(spark, customers, scattered(seed))
    staged = customer_features(**t, config=CONFIG)
    plain = single_step_flags(wide_fact(**t), CONFIG)
    assert rows(staged) == rows(plain.select(*staged.columns))
    assert staged.count() == 45


def test_families_equal_the_full_result(spark):
    customers = [(f"c{i}", at(10 * i), i % 3 > 0) for i in range(45)]
    t = tables(spark, customers, scattered(3))
    full = customer_features(**t, config=CONFIG)
    for name in FAMILIES:
        part = customer_features(**t, config=CONFIG, names=family(name))
        assert part.columns == ["customer_id", *[n for n in FLAG_NAMES if n in family(name)]]
        assert rows(part) == rows(full.select(*part.columns))


def test_breadth_is_exact_and_one_plan_for_any_catalogue(spark):
    customers = [(f"c{i}", at(10 * i), True) for i in range(45)]
    t = tables(spark, customers, scattered(4))
    found = rows(customer_features(**t, config=CONFIG).select("customer_id", "varied_shopper"))
    counts = t["purchases"].join(t["products"], "product_id").groupBy("customer_id").agg(F.count_distinct("category_name").alias("n"))
    wanted = t["customers"].join(counts, "customer_id", "left").select("customer_id", F.expr("coalesce(n >= 4, false)"))
    assert found == rows(wanted)
    many = spark.range(200).select(F.concat(F.lit("p"), "id").alias("product_id"), F.concat(F.lit("c"), "id").alias("category_name"), F.lit(False).alias("is_organic"))
    # the names of nodes of the plan, whatever the catalogue holds; building it starts no job
    spark.sparkContext.setJobGroup("build", "build")
    plans = [plan_of(customer_features(**{**t, "products": p}, config=CONFIG), "simple") for p in (t["products"], many)]
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("build")
    nodes = [re.findall(r"(HashAggregate|Expand)", p) for p in plans]
    assert nodes[0] == nodes[1]


def test_exact_breadth(spark):
    t = tables(spark, [("c0", at(9), True)], scattered(5))
    items = enrich_items(*[t[n] for n in ("purchases", "products", "stores", "address")])

    def ask(m):
        names = ("store_id", "city", "category_name")
        return [m.purchases().alias("n"), *[m.distinct(c).alias(c) for c in names]]

    found = customer_profile(items, CONFIG, ask)
    wanted = items.groupBy("customer_id").agg(
        F.count_distinct("purchase_id"), *[F.count_distinct(c) for c in ("store_id", "city", "category_name")]
    )
    assert rows(found) == rows(wanted)


def test_wide_fact_is_the_left_join_chain(spark):
    customers = [(f"c{i}", at(10 * i), i % 3 > 0) for i in range(45)]
    t = tables(spark, customers, scattered(6))
    chain = (
        t["customers"]
        .withColumn("registration_date", F.to_date("registration_date"))
        .join(t["purchases"], "customer_id", "left")
        .join(t["products"], "product_id", "left")
        .join(t["stores"], "store_id", "left")
        .join(t["address"], "address_id", "left")
        .select(*FACT_COLUMNS)
    )
    fact = wide_fact(**t)
    assert fact.columns == list(FACT_COLUMNS) and rows(fact) == rows(chain)


def test_plan_is_hash_aggregation(spark):
    t = tables(spark, [("a", at(9), True)], [item("a", "p", "tea", at(3))])
    plan = plan_of(customer_features(**t, config=CONFIG))
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "EvalPython" not in plan


def test_default_as_of_is_today(spark):
    now = dt.datetime.now().replace(hour=0, minute=0, second=0, microsecond=0)
    found = flags(spark, [item("a", "p", "beef", now)], config=FeatureConfig())
    assert "bought_meat_last_week" in found["a"]


def test_cities_of_stores_are_broadcast_without_waiting_for_their_size(spark):
    t = tables(spark, [("c1", at(10), True)], [item("c1", "o1", "milk", at(1), "100")])
    plan = plan_of(enrich_items(*[t[name] for name in ("purchases", "products", "stores", "address")], keep_cities=True), "simple")
    (looked_up,) = [line for line in plan.splitlines() if "Join" in line and "store_id" in line]
    assert "BroadcastHashJoin" in looked_up
