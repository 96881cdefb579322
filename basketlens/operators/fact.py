"""The wide item-grain fact: customers, purchase items, products, stores and their city."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.session import staged
from basketlens.sinks.bykey import TableByKey

# The columns the fact takes from purchases, and its own.
PURCHASE_COLUMNS = (
    "purchase_id",
    "store_id",
    "customer_id",
    "product_id",
    "total_amount",
    "payment_method",
    "is_delivery",
    "purchase_datetime",
    "load_date",
)

FACT_COLUMNS = (
    "purchase_id",
    "store_id",
    "customer_id",
    "product_id",
    "category_name",
    "is_organic",
    "total_amount",
    "payment_method",
    "is_delivery",
    "city",
    "purchase_datetime",
    "registration_date",
    "is_loyalty_member",
    "load_date",
)


def enrich_items(
    purchases: DataFrame,
    products: DataFrame,
    stores: DataFrame,
    address: DataFrame,
    keep_cities: bool = False,
) -> DataFrame:
    """Purchase items with category, organic mark and store city."""
    return _looked_up(purchases.select(*PURCHASE_COLUMNS), products, stores, address, keep_cities)


def _looked_up(
    items: DataFrame, products: DataFrame, stores: DataFrame, address: DataFrame, keep_cities: bool = False
) -> DataFrame:
    """items, all columns, with what products and stores say.

    Stores and addresses are joined to each other first: the address mart also holds the addresses of
    all customers and would otherwise be joined to every item. Items are the kept side of both left
    joins; adaptive execution broadcasts a looked-up table whose measured size allows it, and can split a
    product or store that holds much of the data where it does not.

    With `keep_cities` a job writes the cities of stores first. Else the optimizer takes them to be as large as the product
    of stores and addresses, and all items may be shuffled before they are measured.
    """
    places = stores.select("store_id", "address_id").join(address.select("address_id", "city"), "address_id", "left")
    places = places.select("store_id", "city")
    if keep_cities:
        places = staged(places, "places")
    kinds = products.select("product_id", "category_name", "is_organic")
    return items.join(kinds, "product_id", "left").join(places, "store_id", "left")


def _known(customers: DataFrame) -> DataFrame:
    registered = F.to_date("registration_date").alias("registration_date")
    return customers.select("customer_id", registered, "is_loyalty_member")


def wide_fact(
    customers: DataFrame, purchases: DataFrame, products: DataFrame, stores: DataFrame, address: DataFrame
) -> DataFrame:
    """One row per purchase item of a known customer, and one row per customer without purchases.

    The left join from customers is written as matches plus customers without a match. A single left
    join would hold all items of one customer in one task, since only its kept side can be split; an
    inner join can be split on the item side. Customers without a match come from the distinct ids of
    the purchases, which are reduced before they are shuffled.
    """
    who = _known(customers)
    items = enrich_items(purchases, products, stores, address, keep_cities=True)
    matched = items.join(who, "customer_id").select(*FACT_COLUMNS)
    buyers = purchases.select("customer_id").distinct()
    unmatched = who.join(buyers, "customer_id", "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def stored_fact(
    customers: TableByKey, purchases: TableByKey, products: DataFrame, stores: DataFrame, address: DataFrame
) -> DataFrame:
    """The rows of `wide_fact`, of customers and purchases that are stored by customer_id in the same buckets.

    Bucket joins bucket: neither side is shuffled, purchases are read once, and one left join gives matches and
    customers without purchases alike. Customers with more rows than an even bucket, at most one a bucket, are kept
    apart on both sides and joined by broadcast, so their rows stay where they are read. Customers are stored as unique.
    """
    if customers.buckets != purchases.buckets or (customers.key, purchases.key) != ("customer_id", "customer_id"):
        raise ValueError("customers and purchases must be stored by customer_id in the same buckets")
    if not customers.unique:
        raise ValueError("customers must be stored as unique")
    spark = products.sparkSession
    frequent = F.broadcast(purchases.frequent(spark))
    who = _known(customers.usual(spark))
    rare = who.join(frequent, "customer_id", "left_anti")
    usual = rare.join(purchases.usual(spark).select(*PURCHASE_COLUMNS), "customer_id", "left")
    known = F.broadcast(who.join(frequent, "customer_id", "left_semi"))
    often = purchases.often(spark).select(*PURCHASE_COLUMNS).join(known, "customer_id")
    items = usual.unionByName(often)
    return _looked_up(items, products, stores, address).select(*FACT_COLUMNS)
