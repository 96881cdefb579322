import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens import schemas
from basketlens.operators import dedup, marts, quality
from helpers import plan_of, rows

LOADED = dt.datetime(2024, 5, 1, 10, 0, 0)


def raw(spark, entity, defaults, *changes):
    """RAW rows of an entity: the defaults, each time with some columns changed."""
    names = list(defaults)
    schema = ", ".join(f"`{n}` {'timestamp' if n == 'load_date' else 'string'}" for n in names)
    return spark.createDataFrame([tuple((defaults | c)[n] for n in names) for c in changes], schema)


PRODUCT = {
    "record_id": "r",
    "product_id": "prd-1",
    "name": " Хлеб ",
    "group": "🥖 Зерновые и хлебобулочные изделия",
    "description": "D",
    "kbju_calories": "120.5",
    "kbju_protein": "x",
    "kbju_fat": None,
    "kbju_carbohydrates": "1",
    "price": "55.70",
    "unit": "ШТ",
    "origin_country": "Россия",
    "expiry_days": "10",
    "is_organic": "True",
    "barcode": "4600",
    "manufacturer_name": " ООО Хлеб",
    "manufacturer_country": "Россия",
    "manufacturer_website": "HTTPS://X.RU",
    "manufacturer_inn": "1234567890",
    "load_date": LOADED,
}


def test_products(spark):
    df = raw(
        spark,
        "products",
        PRODUCT,
        {},
        {"product_id": "zero", "price": "0"},
        {"product_id": "minus", "price": "-1"},
        {"product_id": "text", "price": "abc"},
        {"product_id": "no barcode", "barcode": ""},
        {"product_id": "null unit", "unit": None},
        {"product_id": ""},
    )
    built = marts.PRODUCTS.build(df)
    assert [f.dataType for f in built.schema.fields] == [
        f.dataType for f in T.StructType.fromDDL(schemas.MART["products"]).fields
    ]
    (row,) = built.collect()
    assert row["product_id"] == "prd-1" and row["product_name"] == "хлеб"
    assert row["category_name"] == "зерновые и хлебобулочные изделия"
    assert row["price"] == Decimal("55.70") and row["kbju_calories"] == 120.5
    assert row["kbju_protein"] is None and row["expiry_days"] == 10 and row["is_organic"] is True
    assert rows(marts.PRODUCTS.reject_counts(df)) == [("barcode", 1), ("price", 3), ("product_id", 1), ("unit", 1)]


def test_manufacturers_share_their_key_with_products(spark):
    df = raw(
        spark,
        "products",
        PRODUCT,
        {},
        {"manufacturer_inn": "123456789"},
        {"manufacturer_inn": "12345678901"},
        {"manufacturer_inn": "12345abcde"},
        {"manufacturer_name": ""},
    )
    (maker,) = marts.MANUFACTURERS.build(df).collect()
    assert maker["manufacturer_name"] == "ооо хлеб" and maker["website"] == "https://x.ru"
    keys = [r["manufacturer_id"] for r in marts.PRODUCTS.build(df).collect()]
    assert maker["manufacturer_id"] == keys[0] and len(keys) == 5


CUSTOMER = {
    "record_id": "r",
    "customer_id": "cus-1",
    "first_name": "Анна",
    "last_name": "П",
    "email": "token",
    "phone": None,
    "birth_date": "1990-01-01",
    "gender": "FEMALE",
    "registration_date": "2024-04-30T09:00:00.5",
    "is_loyalty_member": "True",
    "loyalty_card_number": "L",
    "purchase_location_country": "Россия",
    "purchase_location_city": "Омск",
    "purchase_location_street": " Мира ",
    "purchase_location_house": "1",
    "purchase_location_postal_code": "644000",
    "purchase_location_coordinates_latitude": "55.1",
    "purchase_location_coordinates_longitude": "bad",
    "delivery_address_country": "Россия",
    "delivery_address_city": "Омск",
    "delivery_address_street": "Мира",
    "delivery_address_house": "1",
    "delivery_address_apartment": "7",
    "delivery_address_postal_code": "644000",
    "preferences_preferred_language": "ru",
    "preferences_preferred_payment_method": "CARD",
    "preferences_receive_promotions": "False",
    "load_date": LOADED,
}


def test_customers(spark):
    df = raw(
        spark,
        "customers",
        CUSTOMER,
        {},
        {"customer_id": "born on load day", "birth_date": "2024-05-01"},
        {"customer_id": "registered on load day", "registration_date": "2024-05-01T23:00:00"},
        {"customer_id": "registered later", "registration_date": "2024-05-02T00:00:00"},
        {"customer_id": "no member", "is_loyalty_member": "False"},
        {"customer_id": "no card", "loyalty_card_number": ""},
        {"customer_id": "no name", "first_name": None},
        {"customer_id": "odd birth", "birth_date": "unknown"},
    )
    built = marts.CUSTOMERS.build(df).collect()
    assert sorted(r["customer_id"] for r in built) == ["cus-1", "registered on load day"]
    addresses = marts.build_address(df.limit(1), stores(spark)).collect()
    known = {r["address_id"] for r in addresses}
    row = next(r for r in built if r["customer_id"] == "cus-1")
    assert {row["purchase_address_id"], row["delivery_address_id"]} <= known
    assert row["preferences_receive_promotions"] is False


STORE = {
    "record_id": "r",
    "store_id": "store-1",
    "store_name": " Магазин ",
    "store_network": "N",
    "store_type_description": "T",
    "type": "offline",
    "categories": "🥖 Хлеб|🥦 Овощи",
    "manager_name": "M",
    "manager_phone": None,
    "manager_email": None,
    "location_country": "Россия",
    "location_city": "Омск",
    "location_street": "Ленина",
    "location_house": "5",
    "location_postal_code": "644001",
    "location_coordinates_latitude": "1.5",
    "location_coordinates_longitude": "2.5",
    "opening_hours_mon_fri": "9-21",
    "opening_hours_sat": "10-20",
    "opening_hours_sun": "10-18",
    "accepts_online_orders": "True",
    "delivery_available": "False",
    "warehouse_connected": "?",
    "last_inventory_date": "2024-04-01",
    "load_date": LOADED,
}


def stores(spark, *changes):
    return raw(spark, "stores", STORE, *(changes or ({},)))


def test_stores(spark):
    df = stores(spark, {}, {"store_id": ""}, {"store_name": None})
    (row,) = marts.STORES.build(df).collect()
    assert row["categories"] == ["хлеб", "овощи"] and row["warehouse_connected"] is None
    assert row["last_inventory_date"] == dt.date(2024, 4, 1)


def test_address_from_three_writers(spark):
    customers = raw(
        spark,
        "customers",
        CUSTOMER,
        {},
        {"purchase_location_street": "", "delivery_address_house": None},
        {"delivery_address_apartment": "8"},
    )
    built = marts.build_address(customers, stores(spark))
    assert built.count() == 2 + 2 + 1
    current = dedup.latest_by_key(built, ("address_id",)).collect()
    assert len(current) == 4
    assert all(r["load_date"] is not None for r in current)
    flats = {r["apartment"] for r in current}
    assert flats == {None, "7", "8"}
    store = next(r for r in current if r["street"] == "ленина")
    assert (store["coordinates_latitude"], store["coordinates_longitude"]) == (1.5, 2.5)


PURCHASE = {
    "record_id": "r",
    "purchase_id": "ord-1",
    "customer_customer_id": "cus-1",
    "store_store_id": "store-1",
    "items": '[{"product_id": "prd-1", "quantity": 2, "unit": "ШТ ", "price_per_unit": 10.5, "total_price": 21.0},'
    ' {"product_id": "prd-2", "quantity": "1", "unit": "шт", "price_per_unit": 3, "total_price": 3}]',
    "total_amount": "24.00",
    "payment_method": " Card",
    "is_delivery": "True",
    "delivery_address_city": "Омск",
    "delivery_address_street": "Мира",
    "delivery_address_house": "1",
    "delivery_address_apartment": "7",
    "delivery_address_postal_code": "644000",
    "purchase_datetime": "2024-04-30T21:00:00.123456",
    "load_date": LOADED,
}


def test_purchases(spark):
    good = '{"product_id": "prd-9", "quantity": 1, "unit": "шт", "price_per_unit": 3, "total_price": 3}'
    df = raw(
        spark,
        "purchases",
        PURCHASE,
        {},
        {"purchase_id": "empty", "items": "[]"},
        {"purchase_id": "broken", "items": '[{"product_id": '},
        {"purchase_id": "null", "items": None},
        {"purchase_id": "quantity", "items": "[" + good.replace('"quantity": 1', '"quantity": 0') + "]"},
        {"purchase_id": "product", "items": "[" + good.replace("prd-9", "") + "]"},
        {"purchase_id": "unit", "items": "[" + good.replace("шт", "") + "]"},
        {"purchase_id": "total", "items": f"[{good}]", "total_amount": "0"},
        {"purchase_id": "total text", "items": f"[{good}]", "total_amount": "much"},
        {"purchase_id": "customer", "items": f"[{good}]", "customer_customer_id": None},
        {"purchase_id": "", "items": f"[{good}]"},
    )
    built = marts.PURCHASES.build(df)
    assert rows(built, "purchase_id", "product_id", "quantity", "unit", "total_item_price") == [
        ("ord-1", "prd-1", 2.0, "шт", Decimal("21.00")),
        ("ord-1", "prd-2", 1.0, "шт", Decimal("3.00")),
    ]
    row = built.first()
    assert row["payment_method"] == "card" and row["is_delivery"] is True
    assert row["total_amount"] == Decimal("24.00")
    rejected = dict(marts.PURCHASES.reject_counts(df).collect())
    assert rejected == {
        "quantity": 1,
        "product_id": 1,
        "unit": 1,
        "total_amount": 2,
        "customer_customer_id": 1,
        "purchase_id": 1,
    }


def test_full_delivery_key_equals_the_customers_one(spark):
    customer = marts.CUSTOMERS.build(raw(spark, "customers", CUSTOMER, {})).first()
    df = raw(spark, "purchases", PURCHASE, {}).withColumn("delivery_address_country", F.lit("РОССИЯ"))
    assert marts.PURCHASES_FULL_KEY.build(df).first()["delivery_address_id"] == customer["delivery_address_id"]
    assert marts.PURCHASES.build(df).first()["delivery_address_id"] != customer["delivery_address_id"]


def test_views_do_not_shuffle(spark):
    for view, defaults in (
        (marts.PRODUCTS, PRODUCT),
        (marts.CUSTOMERS, CUSTOMER),
        (marts.STORES, STORE),
        (marts.PURCHASES, PURCHASE),
    ):
        plan = plan_of(view.build(raw(spark, view.source, defaults, {})))
        assert "Exchange" not in plan and "EvalPython" not in plan


def test_eight_views_feed_six_marts():
    assert len(marts.VIEWS) == 8 and {v.target for v in marts.VIEWS} == set(schemas.MART)


def test_quality_rules_are_never_null(spark):
    df = raw(spark, "products", {k: None for k in PRODUCT} | {"load_date": None}, {})
    for rule in marts.PRODUCTS.rules().values():
        assert df.select(rule).first()[0] is False
    assert quality.rejected(df, marts.PRODUCTS.rules()).count() == 1


def test_views_are_routed_without_a_generator_over_their_rows(spark):
    changes = ({}, {"price": "0"}, {"manufacturer_inn": "12"}, {"product_id": None, "manufacturer_name": None})
    found = marts.routed(raw(spark, "products", PRODUCT, *changes), marts.views_of("products"))
    assert not [line for line in plan_of(found, "simple").split("\n") if "Generate" in line and "RLIKE" in line]
    told = found.selectExpr("view", "mart", "product_id", "inn", "rejected.failed_rules", "rejected.price AS was", "load_date")
    products, makers, refused = "products", "manufacturers", marts.REJECTED
    assert [tuple(r)[:-1] for r in told.orderBy("view", "mart", "inn", "was").collect() if r.load_date == LOADED] == [
        (makers, makers, None, "1234567890", None, None),
        (makers, makers, None, "1234567890", None, None),
        (makers, refused, None, None, ["manufacturer_inn_digits"], "55.70"),
        (makers, refused, None, None, ["manufacturer_name"], "55.70"),
        (products, products, "prd-1", None, None, None),
        (products, products, "prd-1", None, None, None),
        (products, refused, None, None, ["price"], "0"),
        (products, refused, None, None, ["product_id"], "55.70"),
    ]
