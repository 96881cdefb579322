"""RAW rows to MART rows: one view per writer and target, each a filter and a projection.

No view shuffles. Versions under one key are settled when a mart is read (``dedup.current_rows``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens import schemas
from basketlens.functions import casts
from basketlens.functions import predicates as p
from basketlens.functions.keys import normalized_key
from basketlens.functions.text import category, normalize, split_list
from basketlens.operators import quality


@dataclass(frozen=True)
class View:
    """A transform from one RAW table to one mart.

    ``prepare`` changes the grain where needed, ``rules`` decide which rows are kept (by name, so
    rejects can be explained), ``columns`` give the mart columns; those of the mart schema that a view
    does not supply are NULL.
    """

    name: str
    source: str
    target: str
    rules: Callable[[], dict[str, Column]]
    columns: Callable[[], dict[str, Column]]
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df

    def build(self, raw: DataFrame) -> DataFrame:
        kept = quality.accepted(self.prepare(raw), self.rules())
        supplied = self.columns()
        schema = T.StructType.fromDDL(schemas.MART[self.target])
        return kept.select(
            *[supplied.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
        )

    def rejects(self, raw: DataFrame) -> DataFrame:
        return quality.rejected(self.prepare(raw), self.rules())

    def reject_counts(self, raw: DataFrame) -> DataFrame:
        return quality.rejection_counts(self.prepare(raw), self.rules())


PLACE = ("country", "city", "street", "house", "postal_code")
DELIVERY = ("country", "city", "street", "house", "apartment", "postal_code")


def _under(prefix: str, names: tuple[str, ...]) -> list[str]:
    return [f"{prefix}_{name}" for name in names]


def _filled(*names: str) -> dict[str, Column]:
    return {name: p.non_blank(F.col(name)) for name in names}


def _normalized(*names: str) -> dict[str, Column]:
    return {name: normalize(F.col(name)) for name in names}


def _as_is(*names: str) -> dict[str, Column]:
    return {name: F.col(name) for name in names}


def place_key(prefix: str) -> Column:
    return normalized_key(*_under(prefix, PLACE))


def delivery_key(prefix: str) -> Column:
    return normalized_key(*_under(prefix, DELIVERY))


def _address_view(name: str, source: str, prefix: str, parts: tuple[str, ...]) -> View:
    def columns() -> dict[str, Column]:
        out = {"address_id": normalized_key(*_under(prefix, parts)), "load_date": F.col("load_date")}
        out |= {part: normalize(F.col(f"{prefix}_{part}")) for part in parts}
        if parts is PLACE:
            for axis in ("latitude", "longitude"):
                out[f"coordinates_{axis}"] = casts.double(F.trim(F.col(f"{prefix}_coordinates_{axis}")))
        return out

    return View(name, source, "address", lambda: _filled(*_under(prefix, PLACE)), columns)


def _maker_key() -> Column:
    return normalized_key("manufacturer_name", "manufacturer_inn")


def _manufacturer_rules() -> dict[str, Column]:
    return _filled("manufacturer_name", "manufacturer_inn") | {
        "manufacturer_inn_digits": p.is_tax_number(F.col("manufacturer_inn"))
    }


def _manufacturer_columns() -> dict[str, Column]:
    return {
        "manufacturer_id": _maker_key(),
        "manufacturer_name": normalize(F.col("manufacturer_name")),
        "country": normalize(F.col("manufacturer_country")),
        "website": normalize(F.col("manufacturer_website")),
        "inn": normalize(F.col("manufacturer_inn")),
        "load_date": F.col("load_date"),
    }


def _product_rules() -> dict[str, Column]:
    return _filled("product_id", "barcode", "unit") | {"price": p.positive_money(F.col("price"))}


def _product_columns() -> dict[str, Column]:
    nutrition = ("kbju_calories", "kbju_protein", "kbju_fat", "kbju_carbohydrates")
    return (
        {
            "product_id": F.col("product_id"),
            "product_name": normalize(F.col("name")),
            "category_name": category(F.col("group")),
            "price": casts.money(F.col("price")),
            "expiry_days": casts.short(F.col("expiry_days")),
            "is_organic": casts.boolean(F.col("is_organic")),
            "manufacturer_id": _maker_key(),
            "load_date": F.col("load_date"),
        }
        | {name: casts.real(F.col(name)) for name in nutrition}
        | _normalized("description", "unit", "origin_country", "barcode")
    )


def _customer_rules() -> dict[str, Column]:
    load_day = F.col("load_date")
    return _filled("customer_id", "first_name", "loyalty_card_number") | {
        "birth_date": p.date_before(F.col("birth_date"), load_day),
        "registration_date": p.date_not_after(F.col("registration_date"), load_day),
        "is_loyalty_member": p.is_true_text(F.col("is_loyalty_member")),
    }


def _customer_columns() -> dict[str, Column]:
    return (
        {
            "birth_date": casts.date(F.col("birth_date")),
            "registration_date": casts.timestamp(F.col("registration_date")),
            "is_loyalty_member": casts.boolean(F.col("is_loyalty_member")),
            "purchase_address_id": place_key("purchase_location"),
            "delivery_address_id": delivery_key("delivery_address"),
            "preferences_receive_promotions": casts.boolean(F.col("preferences_receive_promotions")),
        }
        | _as_is("customer_id", "email", "phone", "loyalty_card_number", "load_date")
        | _normalized(
            "first_name",
            "last_name",
            "gender",
            "preferences_preferred_language",
            "preferences_preferred_payment_method",
        )
    )


def _store_columns() -> dict[str, Column]:
    flags = ("accepts_online_orders", "delivery_available", "warehouse_connected")
    return (
        {
            "categories": F.transform(split_list(F.col("categories")), category),
            "address_id": place_key("location"),
            "last_inventory_date": casts.date(F.col("last_inventory_date")),
        }
        | {name: casts.boolean(F.col(name)) for name in flags}
        | _as_is(
            "store_id",
            "type",
            "manager_phone",
            "manager_email",
            "opening_hours_mon_fri",
            "opening_hours_sat",
            "opening_hours_sun",
            "load_date",
        )
        | _normalized("store_name", "store_network", "store_type_description", "manager_name")
    )


#: fields of a purchase item the mart reads; as text, so bad numbers reach the row checks
ITEM = "array<struct<product_id: string, quantity: string, unit: string, price_per_unit: string, total_price: string>>"


def explode_items(raw: DataFrame, items: str = "items") -> DataFrame:
    """One row per element of the JSON list; an empty or unreadable list gives no row."""
    return raw.withColumn("item", F.explode(F.from_json(F.col(items), ITEM))).drop(items)


def _purchase_rules() -> dict[str, Column]:
    return {
        "quantity": p.positive_real(F.col("item.quantity")),
        "price_per_unit": p.positive_real(F.col("item.price_per_unit")),
        "unit": p.non_blank(F.col("item.unit")),
        "product_id": p.non_blank(F.col("item.product_id")),
        "total_amount": p.positive_money(F.col("total_amount")),
    } | _filled("purchase_id", "customer_customer_id")


def _purchase_columns(full_delivery_key: bool) -> dict[str, Column]:
    parts = DELIVERY if full_delivery_key else DELIVERY[1:]
    return {
        "purchase_id": F.col("purchase_id"),
        "store_id": F.col("store_store_id"),
        "customer_id": F.col("customer_customer_id"),
        "product_id": F.col("item.product_id"),
        "quantity": casts.real(F.col("item.quantity")),
        "unit": normalize(F.col("item.unit")),
        "price_per_unit": casts.money(F.col("item.price_per_unit")),
        "total_item_price": casts.money(F.col("item.total_price")),
        "total_amount": casts.money(F.col("total_amount")),
        "payment_method": normalize(F.col("payment_method")),
        "is_delivery": casts.boolean(F.col("is_delivery")),
        "delivery_address_id": normalized_key(*_under("delivery_address", parts)),
        "purchase_datetime": casts.timestamp(F.col("purchase_datetime")),
        "load_date": F.col("load_date"),
    }


ADDRESS_FROM_PURCHASE_LOCATION = _address_view(
    "address_from_purchase_location", "customers", "purchase_location", PLACE
)
ADDRESS_FROM_DELIVERY = _address_view("address_from_delivery_address", "customers", "delivery_address", DELIVERY)
ADDRESS_FROM_STORES = _address_view("address_from_stores", "stores", "location", PLACE)
MANUFACTURERS = View("manufacturers", "products", "manufacturers", _manufacturer_rules, _manufacturer_columns)
PRODUCTS = View("products", "products", "products", _product_rules, _product_columns)
CUSTOMERS = View("customers", "customers", "customers", _customer_rules, _customer_columns)
STORES = View("stores", "stores", "stores", lambda: _filled("store_id", "store_name"), _store_columns)
#: The RAW purchase table holds no delivery country, so this key covers five parts and names another
#: thing than the six-part address key of customers.
PURCHASES = View(
    "purchases",
    "purchases",
    "purchases",
    _purchase_rules,
    lambda: _purchase_columns(full_delivery_key=False),
    explode_items,
)
#: For RAW tables that keep ``delivery_address_country``: the key then equals the customers' one.
PURCHASES_FULL_KEY = View(
    "purchases_full_key",
    "purchases",
    "purchases",
    _purchase_rules,
    lambda: _purchase_columns(full_delivery_key=True),
    explode_items,
)

VIEWS = (
    ADDRESS_FROM_PURCHASE_LOCATION,
    ADDRESS_FROM_DELIVERY,
    ADDRESS_FROM_STORES,
    MANUFACTURERS,
    PRODUCTS,
    CUSTOMERS,
    STORES,
    PURCHASES,
)


def views_of(source: str) -> list[View]:
    return [view for view in VIEWS if view.source == source]


#: The table, by name of the mart, that rows go to which a view refuses.
REJECTED = "rejected"


def routed(raw: DataFrame, views: list[View], keep_rejects: bool = True) -> DataFrame:
    """What all views make of RAW rows, from one pass over them.

    Each row of a view's grain gives one row a view: `mart` and `view` say where it belongs, and it holds the columns of all
    marts that the views write, those of its own mart filled. A row that a view refuses belongs to REJECTED; it is kept
    whole in the struct `rejected`, with the rules it fails. The views must agree on their grain.
    """
    (prepare,) = {view.prepare for view in views}
    prepared = prepare(raw)
    columns: dict[str, T.DataType] = {}
    for view in views:
        for f in T.StructType.fromDDL(schemas.MART[view.target]).fields:
            if columns.setdefault(f.name, f.dataType) != f.dataType:
                raise ValueError(f"{f.name} has two types")
    source = [F.col(f"`{c}`") for c in prepared.columns]
    numbered = [*enumerate(views)]

    # every step is a projection of its own over what the one before has settled: rules are looked at once a row, values are
    # made for accepted rows only, and all of it is compiled (a generator over whole rows would be interpreted)
    passed = {(i, name): f"_passed_{i}_{name}" for i, view in numbered for name in view.rules()}
    checked = prepared.withColumns(
        {passed[i, name]: F.coalesce(rule, F.lit(False)) for i, view in numbered for name, rule in view.rules().items()}
    )
    if len(views) > 1:
        checked = checked.withColumn("_view", F.explode(F.array(*[F.lit(i) for i, _ in numbered])))
    else:
        checked = checked.withColumn("_view", F.lit(0))

    def one_of(made: Callable[[int, View], Column | None], number: str, otherwise: Column) -> Column:
        found = otherwise
        for i, view in reversed(numbered):
            if (c := made(i, view)) is not None:
                found = F.when(F.col(number) == i, c).otherwise(found)
        return found

    none = F.lit(None)
    accepted = one_of(lambda i, view: reduce(and_, [F.col(passed[i, n]) for n in view.rules()], F.lit(True)), "_view", F.lit(False))
    judged = checked.withColumn("_accepted", F.when(accepted, F.col("_view")).otherwise(-1))

    def value(name: str, kind: T.DataType) -> Column:
        def made(i: int, view: View) -> Column | None:
            own = {f.name for f in T.StructType.fromDDL(schemas.MART[view.target]).fields}
            supplied = view.columns().get(name) if name in own else None
            return None if supplied is None else supplied.cast(kind)

        refused = F.col("load_date").cast(kind) if name == "load_date" else none.cast(kind)
        if name == "load_date":
            refused = F.when(F.col("_accepted") < 0, refused)
        return one_of(made, "_accepted", refused)

    failed = one_of(
        lambda i, view: quality.failed_rules({n: F.col(passed[i, n]) for n in view.rules()}), "_view", none.cast("array<string>")
    )
    found = judged.select(
        one_of(lambda i, view: F.lit(view.target), "_accepted", F.lit(REJECTED)).alias("mart"),
        one_of(lambda i, view: F.lit(view.name), "_view", none).alias("view"),
        *[value(c, kind).alias(c) for c, kind in columns.items()],
        F.when(F.col("_accepted") < 0, F.struct(*source, failed.alias("failed_rules"))).alias("rejected"),
    )
    return found if keep_rejects else found.filter(F.col("mart") != REJECTED)


def build_address(raw_customers: DataFrame, raw_stores: DataFrame) -> DataFrame:
    """All three writers of the address mart in one table, before versions are settled."""
    return (
        ADDRESS_FROM_PURCHASE_LOCATION.build(raw_customers)
        .unionByName(ADDRESS_FROM_DELIVERY.build(raw_customers))
        .unionByName(ADDRESS_FROM_STORES.build(raw_stores))
    )
