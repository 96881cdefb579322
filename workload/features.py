"""Customer flags, their families, and the aggregates below them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.config import CategoryRoles
from basketlens.operators import days, dedup, marts
from basketlens.operators.fact import PURCHASE_COLUMNS, enrich_items, stored_fact, wide_fact
from basketlens.operators.features import FAMILIES, FLAG_NAMES, customer_features, customer_profile, family
from basketlens.schemas import MART_KEYS
from basketlens.session import scratch_path, shuffles_dropped, staged
from basketlens.sinks.bykey import TableByKey
from workload.adapter import CONFIG, Supplied
from workload.case import Case, with_domain
from workload.marts import SQL_ADDRESS, SQL_CUSTOMERS, SQL_PRODUCTS, SQL_PURCHASES, SQL_STORES

DOMAIN_NAMES = ("customers", "purchases", "products", "stores", "address")

FACT = """
    SELECT p.purchase_id, p.store_id, c.customer_id, p.product_id, r.category_name, r.is_organic, p.total_amount,
           p.payment_method, p.is_delivery, a.city, p.purchase_datetime,
           CAST(c.registration_date AS DATE) AS registration_date, c.is_loyalty_member, p.load_date
    FROM customers c
    LEFT JOIN {purchases} p ON p.customer_id = c.customer_id
    LEFT JOIN products r ON r.product_id = p.product_id
    LEFT JOIN stores s ON s.store_id = p.store_id
    LEFT JOIN address a ON a.address_id = s.address_id"""

NEWEST = """newest AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY purchase_id, product_id ORDER BY store_id DESC) AS version
        FROM purchases WHERE load_date = (SELECT max(load_date) FROM purchases)) WHERE version = 1)"""

MEASURES = """
    SELECT customer_id,
           bool_or(category_name = 'economy' AND d >= T - 180) AS dairy,
           bool_or(category_name = 'medium' AND d >= T - 84) AS fruit,
           count(CASE WHEN category_name = 'standard' AND d >= T - 84 THEN product_id END) AS vegetables,
           count(DISTINCT CASE WHEN d >= T - 180 THEN purchase_id END) AS n_month,
           count(DISTINCT purchase_id) AS n,
           max(d) AS last_purchase,
           bool_or(registration_date >= T - 180) AS registered,
           bool_or(is_loyalty_member) AS loyal,
           bool_or(is_delivery) AS delivery,
           bool_or(is_organic) AS organic,
           sum(total_amount) > 300000 * count(total_amount) AS bulk,
           sum(total_amount) < 150000 * count(total_amount) AS low,
           bool_or(category_name = 'small') AS bakery,
           count(DISTINCT city) AS cities,
           bool_or(category_name = 'promo' AND d >= T - 42) AS meat,
           bool_or(hour(d) > 20) AS night,
           bool_or(hour(d) < 10) AS morning,
           bool_or(hour(d) BETWEEN 12 AND 14) AS midday,
           count(DISTINCT CASE WHEN payment_method = 'cash' THEN purchase_id END) AS n_cash,
           count(DISTINCT CASE WHEN payment_method = 'card' THEN purchase_id END) AS n_card,
           count(DISTINCT CASE WHEN dayofweek(d) IN (0, 6) THEN purchase_id END) AS n_weekend,
           count(DISTINCT category_name) AS categories,
           count(DISTINCT store_id) AS stores,
           bool_or(total_amount >= 400000 AND d >= T - 42) AS spender,
           count(DISTINCT CASE WHEN category_name = 'medium' AND d >= T - 180 THEN purchase_id END) AS n_fruit,
           count(DISTINCT CASE WHEN category_name = 'medium' AND d >= T - 180 THEN category_name END) AS fruit_names,
           count(CASE WHEN category_name = 'promo' AND d >= T - 540 THEN product_id END) AS meat_items
    FROM (SELECT *, purchase_datetime AS d, DATE '2001-08-02' AS T FROM fact) GROUP BY customer_id"""

BASKETS = """
    SELECT customer_id, count(CASE WHEN items = 1 THEN 1 END) AS n_single, avg(items) AS mean_items
    FROM (SELECT customer_id, purchase_id, count(product_id) AS items FROM fact GROUP BY customer_id, purchase_id)
    GROUP BY customer_id"""

FLAG_SQL = {
    "bought_milk_last_30d": "dairy",
    "bought_fruits_last_14d": "fruit",
    "not_bought_veggies_14d": "vegetables = 0",
    "recurrent_buyer": "n_month > 2",
    "inactive_14_30": "last_purchase < DATE '2001-08-02' - 84 AND last_purchase >= DATE '2001-08-02' - 180",
    "new_customer": "registered",
    "delivery_user": "delivery",
    "organic_preference": "organic",
    "bulk_buyer": "bulk",
    "low_cost_buyer": "low",
    "buys_bakery": "bakery",
    "loyal_customer": "n >= 3 AND loyal",
    "multycity_buyer": "cities >= 2",
    "bought_meat_last_week": "meat",
    "night_shopper": "night",
    "morning_shopper": "morning",
    "prefers_cash": "n_cash / nullif(n, 0) >= 0.7",
    "prefers_card": "n_card / nullif(n, 0) >= 0.7",
    "weekend_shopper": "n_weekend / nullif(n, 0) >= 0.6",
    "weekday_shopper": "(n - n_weekend) / nullif(n, 0) >= 0.6",
    "single_item_buyer": "n_single / nullif(n, 0) >= 0.5",
    "varied_shopper": "categories >= 4",
    "store_loyal": "stores = 1",
    "switching_loyal": "stores > 1",
    "family_shopper": "mean_items >= 4",
    "early_bird": "midday",
    "no_purchases": "n = 0",
    "recent_high_spender": "spender",
    "fruit_lover": "n_fruit >= 3",
    "vegetarian_profile": "meat_items = 0",
}


def flags_sql(names=FLAG_NAMES, newest: bool = False, changed: dict[str, str] | None = None) -> str:
    """The named flags, over all purchases or over the newest version of those in the newest load."""
    rules = FLAG_SQL | (changed or {})
    columns = ", ".join(f"coalesce({rules[name]}, false) AS {name}" for name in names)
    fact = FACT.format(purchases="newest" if newest else "purchases")
    steps = f"{NEWEST}, fact AS ({fact})" if newest else f"fact AS ({fact})"
    return with_domain(
        *DOMAIN_NAMES,
        body=f", {steps}, m AS ({MEASURES}), b AS ({BASKETS}) SELECT customer_id, {columns} FROM m JOIN b USING (customer_id)",
    )


# The marts built from RAW hold category names such as "economy, овощи".
RAW_SUFFIX = ", овощи"
RAW_ROLES = ("economy", "medium", "standard", "promo", "small")
RAW_CONFIG = replace(CONFIG, roles=CategoryRoles(*[name + RAW_SUFFIX for name in RAW_ROLES]))
assert CONFIG.roles == CategoryRoles(*RAW_ROLES)

PURCHASE_TIES = (
    "store_id customer_id quantity unit price_per_unit total_item_price total_amount payment_method is_delivery "
    "delivery_address_id purchase_datetime"
).split()


def _report_from_raw(s: Supplied) -> DataFrame:
    """The whole way: RAW rows through the views, newest versions, flags."""
    views = {v.name: v for v in marts.VIEWS}
    read = {
        "customers": ("customer_id", "registration_date", "is_loyalty_member"),
        "purchases": PURCHASE_COLUMNS,
        "products": ("product_id", "category_name", "is_organic"),
        "stores": ("store_id", "address_id"),
    }
    with shuffles_dropped(s.spark):
        current = {
            name: dedup.current_rows_once(views[name].build(s.domain(f"raw_{name}")), MART_KEYS[name], columns)
            for name, columns in read.items()
        }
    addresses = marts.build_address(s.domain("raw_customers"), s.domain("raw_stores"))
    current["address"] = dedup.latest_by_key(addresses, MART_KEYS["address"])
    return customer_features(**current, config=RAW_CONFIG, keep_cities=True)


def _from_days(s: Supplied) -> DataFrame:
    """Flags from days that two loads brought, the first of them twice; no load looks at the other's purchases.

    Day rows read their items twice, so these are looked up once and kept.
    """
    tables = s.marts()
    items = staged(enrich_items(*[tables[name] for name in DOMAIN_NAMES[1:]], keep_cities=True), "items")
    late = F.col("purchase_datetime") >= F.lit(dt.date(2000, 1, 1))
    kept = days.table(scratch_path(s.spark, "days"))
    for number in (0, 1, 0):
        load = items.filter(late if number else ~late)
        kept.upsert(days.day_rows(load, CONFIG), {"purchases": number})
    return days.flags_from_days(tables["customers"], kept.read(s.spark), CONFIG)


def report_sql() -> str:
    ties = ", ".join(f"{c} DESC NULLS LAST" for c in PURCHASE_TIES)
    measures = MEASURES
    for name in RAW_ROLES:
        measures = measures.replace(f"'{name}'", f"'{name}{RAW_SUFFIX}'")
    columns = ", ".join(f"coalesce({FLAG_SQL[name]}, false) AS {name}" for name in FLAG_NAMES)
    return with_domain(
        "raw_customers",
        "raw_products",
        "raw_stores",
        "raw_purchases",
        body=f""", customers AS ({SQL_CUSTOMERS}), products AS ({SQL_PRODUCTS}), stores AS ({SQL_STORES}),
            address AS (SELECT address_id, max(city) AS city FROM ({SQL_ADDRESS}) GROUP BY address_id),
            purchases AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY purchase_id, product_id
                ORDER BY {ties}) AS version FROM ({SQL_PURCHASES})) WHERE version = 1),
            fact AS ({FACT.format(purchases="purchases")}), m AS ({measures}), b AS ({BASKETS})
            SELECT customer_id, {columns} FROM m JOIN b USING (customer_id)""",
    )


def _fact_sql(body: str, newest: bool = False) -> str:
    fact = FACT.format(purchases="newest" if newest else "purchases")
    return with_domain(*DOMAIN_NAMES, body=f", {NEWEST + ', ' if newest else ''}fact AS ({fact}) {body}")


def all_purchases(s: Supplied) -> dict[str, DataFrame]:
    return s.marts()


def newest_purchases(s: Supplied) -> dict[str, DataFrame]:
    tables = s.marts()
    tables["purchases"] = dedup.current_rows(tables["purchases"], MART_KEYS["purchases"])
    return tables


def _flags(read: Callable[[Supplied], dict[str, DataFrame]], names=None, config=CONFIG):
    return lambda s: customer_features(**read(s), config=config, names=names)


def _per_customer(s: Supplied, measure: Callable[[DataFrame], DataFrame], counted: list[str]) -> DataFrame:
    """Measures of the items of the newest load, with the customers that bought nothing in it."""
    tables = newest_purchases(s)
    found = measure(enrich_items(*[tables[name] for name in DOMAIN_NAMES[1:]]))
    return tables["customers"].select("customer_id").join(found, "customer_id", "left").fillna(0, counted)


def _wide(s: Supplied) -> DataFrame:
    return wide_fact(**s.marts())


def _wide_stored(s: Supplied) -> DataFrame:
    """The fact of marts that are stored by customer first."""
    t = s.marts()
    for name in ("customers", "purchases"):
        table = TableByKey(scratch_path(s.spark, name), "customer_id", 16, unique=name == "customers")
        table.write(t[name])
        t[name] = table
    return stored_fact(**t)


def _profile(*ask: tuple[str, Callable]):
    def measure(items: DataFrame) -> DataFrame:
        return customer_profile(items, CONFIG, lambda m: [read(m).alias(name) for name, read in ask])

    # a share of no purchases stays NULL
    return lambda s: _per_customer(s, measure, [name for name, _ in ask if not name.endswith("_share")])


def _conditional_counts(items: DataFrame) -> DataFrame:
    c = F.col
    return (
        items.groupBy("customer_id")
        .agg(
            F.count(F.when(c("category_name") == "standard", c("product_id"))).alias("vegetable_items"),
            F.count(F.when(c("category_name") == "promo", c("product_id"))).alias("meat_items"),
            F.count_if(c("is_delivery")).alias("delivered_items"),
        )
    )


def _basket_thresholds(items: DataFrame) -> DataFrame:
    return (
        items.groupBy("customer_id")
        .agg(
            F.sum("total_amount").alias("amount"),
            F.count("total_amount").alias("item_rows"),
            F.max("purchase_datetime").alias("last_purchase"),
            (F.avg("total_amount") > CONFIG.bulk_above).alias("bulk_buyer"),
            (F.avg("total_amount") < CONFIG.low_below).alias("low_cost_buyer"),
        )
    )


CASES = [
    Case("customer_features", _flags(all_purchases), flags_sql()),
    Case("features_from_days", _from_days, flags_sql()),
    Case("customer_features_newest_load", _flags(newest_purchases), flags_sql(newest=True)),
    Case(
        "customer_features_as_written",
        _flags(newest_purchases, config=replace(CONFIG, fruit_counts="category")),
        flags_sql(newest=True, changed={"fruit_lover": "fruit_names >= 3"}),
    ),
    Case(
        "sorted_features",
        lambda s: customer_features(**newest_purchases(s), config=CONFIG).orderBy("customer_id"),
        flags_sql(newest=True) + " ORDER BY customer_id",
    ),
    *[
        Case(f"features_{name}", _flags(newest_purchases, family(name)), flags_sql(family(name), newest=True))
        for name in FAMILIES
    ],
    Case("report_from_raw", _report_from_raw, report_sql()),
    Case("wide_fact", _wide, _fact_sql("SELECT * FROM fact")),
    Case("wide_fact_stored", _wide_stored, _fact_sql("SELECT * FROM fact")),
    Case(
        "recency_flags",
        _flags(all_purchases, ("bought_milk_last_30d", "bought_fruits_last_14d", "inactive_14_30", "new_customer")),
        flags_sql(("bought_milk_last_30d", "bought_fruits_last_14d", "inactive_14_30", "new_customer")),
    ),
    Case(
        "daypart_flags",
        _flags(all_purchases, ("night_shopper", "morning_shopper", "early_bird")),
        flags_sql(("night_shopper", "morning_shopper", "early_bird")),
    ),
    Case(
        "weekend_share",
        _profile(("weekend_purchases", lambda m: m.purchases("weekend")), ("weekend_share", lambda m: m.share("weekend"))),
        _fact_sql(
            "SELECT customer_id, n_weekend AS weekend_purchases, n_weekend / nullif(n, 0) AS weekend_share "
            f"FROM ({MEASURES})",
            newest=True,
        ),
    ),
    Case(
        "basket_stats",
        _profile(
            ("purchases", lambda m: m.purchases()),
            ("single_item_purchases", lambda m: m.single_item_purchases),
            ("mean_items", lambda m: m.mean_items),
        ),
        _fact_sql(
            "SELECT customer_id, n AS purchases, n_single AS single_item_purchases, mean_items "
            f"FROM ({MEASURES}) JOIN ({BASKETS}) USING (customer_id)",
            newest=True,
        ),
    ),
    Case(
        "conditional_distinct",
        _profile(
            ("purchases", lambda m: m.purchases()),
            ("recent_purchases", lambda m: m.purchases("month")),
            ("cash_purchases", lambda m: m.purchases("cash")),
            ("card_purchases", lambda m: m.purchases("card")),
            ("fruit_purchases", lambda m: m.purchases("fruit_month")),
            ("cities", lambda m: m.distinct("city")),
            ("categories", lambda m: m.distinct("category_name")),
            ("stores", lambda m: m.distinct("store_id")),
        ),
        _fact_sql(
            "SELECT customer_id, n AS purchases, n_month AS recent_purchases, n_cash AS cash_purchases, "
            "n_card AS card_purchases, n_fruit AS fruit_purchases, cities, categories, stores "
            f"FROM ({MEASURES})",
            newest=True,
        ),
    ),
    Case(
        "conditional_counts",
        lambda s: _per_customer(s, _conditional_counts, ["vegetable_items", "meat_items", "delivered_items"]),
        _fact_sql(
            "SELECT customer_id, count(CASE WHEN category_name = 'standard' THEN product_id END) AS vegetable_items, "
            "count(CASE WHEN category_name = 'promo' THEN product_id END) AS meat_items, "
            "count(CASE WHEN is_delivery THEN 1 END) AS delivered_items FROM fact GROUP BY customer_id",
            newest=True,
        ),
    ),
    Case(
        "basket_thresholds",
        lambda s: _per_customer(s, _basket_thresholds, ["item_rows"]),
        _fact_sql(
            "SELECT customer_id, CAST(sum(total_amount) AS DECIMAL(28,2)) AS amount, count(total_amount) AS item_rows, "
            "max(purchase_datetime) AS last_purchase, sum(total_amount) > 300000 * count(*) AS bulk_buyer, "
            "sum(total_amount) < 150000 * count(*) AS low_cost_buyer FROM fact GROUP BY customer_id",
            newest=True,
        ),
    ),
]
