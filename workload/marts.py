"""RAW to MART: the eight views and their parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions import casts, keys, text
from basketlens.functions import predicates as p
from basketlens.operators import dedup, marts
from workload.adapter import Supplied
from workload.case import Case, plain_times, sql_category, sql_filled, sql_key, sql_normal, with_domain

PLACE = ("country", "city", "street", "house", "postal_code")
DELIVERY = ("country", "city", "street", "house", "apartment", "postal_code")


def _sql_key_of(prefix: str, parts: tuple[str, ...]) -> str:
    return sql_key(*sql_normal(*[f"{prefix}_{part}" for part in parts]))


def _sql_address(source: str, prefix: str, parts: tuple[str, ...]) -> str:
    def column(part: str) -> str:
        return f"lower(trim({prefix}_{part})) AS {part}" if part in parts else f"CAST(NULL AS VARCHAR) AS {part}"

    located = parts == PLACE
    axes = [
        (f"TRY_CAST(trim({prefix}_coordinates_{a}) AS DOUBLE)" if located else "CAST(NULL AS DOUBLE)")
        + f" AS coordinates_{a}"
        for a in ("latitude", "longitude")
    ]
    return (
        f"SELECT {_sql_key_of(prefix, parts)} AS address_id, {', '.join(column(part) for part in DELIVERY)}, "
        f"{', '.join(axes)}, load_date FROM {source} WHERE {sql_filled(*[f'{prefix}_{part}' for part in PLACE])}"
    )


SQL_ADDRESS = " UNION ALL ".join(
    [
        _sql_address("raw_customers", "purchase_location", PLACE),
        _sql_address("raw_customers", "delivery_address", DELIVERY),
        _sql_address("raw_stores", "location", PLACE),
    ]
)

SQL_STORE_ADDRESS = _sql_address("raw_stores", "location", PLACE)


def sql_delivery_address(table: str) -> str:
    return _sql_address(table, "delivery_address", DELIVERY)


MAKER_KEY = sql_key(*sql_normal("manufacturer_name", "manufacturer_inn"))

SQL_MANUFACTURERS = f"""
    SELECT {MAKER_KEY} AS manufacturer_id, lower(trim(manufacturer_name)) AS manufacturer_name,
           lower(trim(manufacturer_country)) AS country, lower(trim(manufacturer_website)) AS website,
           lower(trim(manufacturer_inn)) AS inn, load_date
    FROM raw_products
    WHERE {sql_filled("manufacturer_name", "manufacturer_inn")} AND regexp_full_match(manufacturer_inn, '[0-9]{{10}}')"""

SQL_PRODUCTS = f"""
    SELECT product_id, lower(trim(name)) AS product_name, {sql_category('"group"')} AS category_name,
           lower(trim(description)) AS description,
           CAST(TRY_CAST(kbju_calories AS FLOAT) AS DOUBLE) AS kbju_calories,
           CAST(TRY_CAST(kbju_protein AS FLOAT) AS DOUBLE) AS kbju_protein,
           CAST(TRY_CAST(kbju_fat AS FLOAT) AS DOUBLE) AS kbju_fat,
           CAST(TRY_CAST(kbju_carbohydrates AS FLOAT) AS DOUBLE) AS kbju_carbohydrates,
           lower(trim(unit)) AS unit, TRY_CAST(price AS DECIMAL(18,2)) AS price,
           lower(trim(origin_country)) AS origin_country, TRY_CAST(expiry_days AS SMALLINT) AS expiry_days,
           TRY_CAST(is_organic AS BOOLEAN) AS is_organic, lower(trim(barcode)) AS barcode,
           {MAKER_KEY} AS manufacturer_id, load_date
    FROM raw_products
    WHERE {sql_filled("product_id", "barcode", "unit")} AND TRY_CAST(price AS DECIMAL(18,2)) > 0"""

SQL_CUSTOMERS = f"""
    SELECT customer_id, lower(trim(first_name)) AS first_name, lower(trim(last_name)) AS last_name, email, phone,
           TRY_CAST(birth_date AS DATE) AS birth_date, lower(trim(gender)) AS gender,
           date_trunc('second', TRY_CAST(registration_date AS TIMESTAMP)) AS registration_date,
           TRY_CAST(is_loyalty_member AS BOOLEAN) AS is_loyalty_member, loyalty_card_number,
           {_sql_key_of("purchase_location", PLACE)} AS purchase_address_id,
           {_sql_key_of("delivery_address", DELIVERY)} AS delivery_address_id,
           lower(trim(preferences_preferred_language)) AS preferences_preferred_language,
           lower(trim(preferences_preferred_payment_method)) AS preferences_preferred_payment_method,
           TRY_CAST(preferences_receive_promotions AS BOOLEAN) AS preferences_receive_promotions, load_date
    FROM raw_customers
    WHERE {sql_filled("customer_id", "first_name", "loyalty_card_number")}
          AND CAST(birth_date AS DATE) < CAST(load_date AS DATE)
          AND CAST(CAST(registration_date AS TIMESTAMP) AS DATE) <= CAST(load_date AS DATE)
          AND is_loyalty_member = 'True'"""

SQL_STORES = f"""
    SELECT store_id, lower(trim(store_name)) AS store_name, lower(trim(store_network)) AS store_network,
           lower(trim(store_type_description)) AS store_type_description, type,
           array_to_string(list_transform(string_split(categories, '|'), lambda x: {sql_category("x")}), '|') AS categories,
           lower(trim(manager_name)) AS manager_name, manager_phone, manager_email,
           {_sql_key_of("location", PLACE)} AS address_id, opening_hours_mon_fri, opening_hours_sat, opening_hours_sun,
           TRY_CAST(accepts_online_orders AS BOOLEAN) AS accepts_online_orders,
           TRY_CAST(delivery_available AS BOOLEAN) AS delivery_available,
           TRY_CAST(warehouse_connected AS BOOLEAN) AS warehouse_connected,
           TRY_CAST(last_inventory_date AS DATE) AS last_inventory_date, load_date
    FROM raw_stores WHERE {sql_filled("store_id", "store_name")}"""

SQL_ITEMS = """
    SELECT * EXCLUDE (item), json_extract_string(item, '$.product_id') AS product_id,
           json_extract_string(item, '$.quantity') AS quantity, json_extract_string(item, '$.unit') AS unit,
           json_extract_string(item, '$.price_per_unit') AS price_per_unit,
           json_extract_string(item, '$.total_price') AS total_price
    FROM (SELECT *, unnest(json_extract(CASE WHEN json_valid(items) THEN items ELSE '[]' END, '$[*]')) AS item
          FROM raw_purchases)"""

SQL_PURCHASES = f"""
    SELECT purchase_id, store_store_id AS store_id, customer_customer_id AS customer_id, product_id,
           CAST(TRY_CAST(quantity AS FLOAT) AS DOUBLE) AS quantity, lower(trim(unit)) AS unit,
           TRY_CAST(price_per_unit AS DECIMAL(18,2)) AS price_per_unit,
           TRY_CAST(total_price AS DECIMAL(18,2)) AS total_item_price,
           TRY_CAST(total_amount AS DECIMAL(18,2)) AS total_amount, lower(trim(payment_method)) AS payment_method,
           TRY_CAST(is_delivery AS BOOLEAN) AS is_delivery,
           {_sql_key_of("delivery_address", DELIVERY[1:])} AS delivery_address_id,
           date_trunc('second', TRY_CAST(purchase_datetime AS TIMESTAMP)) AS purchase_datetime, load_date
    FROM ({SQL_ITEMS})
    WHERE {sql_filled("unit", "product_id", "purchase_id", "customer_customer_id")}
          AND TRY_CAST(quantity AS FLOAT) > 0 AND TRY_CAST(price_per_unit AS FLOAT) > 0
          AND TRY_CAST(total_amount AS DECIMAL(18,2)) > 0"""

REAL_COLUMNS = ("kbju_calories", "kbju_protein", "kbju_fat", "kbju_carbohydrates", "quantity")


def _comparable(df: DataFrame) -> DataFrame:
    """Single-precision numbers widened and lists joined, for an engine-neutral comparison."""
    changed = {c: F.col(c).cast("double") for c in REAL_COLUMNS if c in df.columns}
    if "categories" in df.columns:
        changed["categories"] = text.join_list(F.col("categories"))
    return plain_times(df.withColumns(changed) if changed else df)


def comparable_mart(df: DataFrame) -> DataFrame:
    return _comparable(df)


def _view(view: marts.View):
    return lambda s: _comparable(view.build(s.domain(f"raw_{view.source}")))


def _address(s: Supplied) -> DataFrame:
    return _comparable(marts.build_address(s.domain("raw_customers"), s.domain("raw_stores")))


def _current_address(s: Supplied) -> DataFrame:
    return _comparable(
        dedup.latest_by_key(marts.build_address(s.domain("raw_customers"), s.domain("raw_stores")), ("address_id",))
    )


def _exploded(s: Supplied) -> DataFrame:
    rows = marts.explode_items(s.domain("raw_purchases"))
    return rows.select("record_id", "purchase_id", "item.*")


def _purchase_rejects(s: Supplied) -> DataFrame:
    return marts.PURCHASES.reject_counts(s.domain("raw_purchases"))


def _typed(s: Supplied) -> DataFrame:
    c = F.col
    return s.domain("raw_products").select(
        "product_id",
        casts.double(c("kbju_calories")).alias("calories"),
        casts.real(c("kbju_protein")).cast("double").alias("protein"),
        casts.money(c("price")).alias("price"),
        casts.short(c("expiry_days")).alias("expiry_days"),
        casts.boolean(c("is_organic")).alias("is_organic"),
    )


def _times(s: Supplied) -> DataFrame:
    """Each purchase time in one of five notations, read back."""
    return plain_times(
        s.spark.sql(NOTATIONS, orders=s.table("orders")).select(
            "o_orderkey",
            casts.timestamp(F.col("moment")).alias("moment"),
            casts.date(F.col("day")).alias("day"),
        )
    )


NOTATIONS = """
    SELECT o_orderkey, day,
           CASE o_orderkey % 5
               WHEN 0 THEN day || 'T10:20:30.123456'
               WHEN 1 THEN day || ' 10:20:30'
               WHEN 2 THEN substr(day, 9, 2) || '.' || substr(day, 6, 2) || '.' || substr(day, 1, 4) || ' 10:20:30'
               WHEN 3 THEN replace(day, '-', '/') || ' 10:20:30'
               ELSE 'no date' END AS moment
    FROM (SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS STRING) AS day FROM {orders})"""

CASES = [
    Case("mart_address", _address, with_domain("raw_customers", "raw_stores", body=SQL_ADDRESS)),
    Case(
        "mart_address_current",
        _current_address,
        with_domain(
            "raw_customers",
            "raw_stores",
            body=f""", a AS ({SQL_ADDRESS}) SELECT * EXCLUDE (version) FROM (
                SELECT *, row_number() OVER (PARTITION BY address_id ORDER BY load_date DESC,
                    coordinates_latitude DESC NULLS LAST, coordinates_longitude DESC NULLS LAST) AS version
                FROM a) WHERE version = 1""",
        ),
    ),
    Case("mart_manufacturers", _view(marts.MANUFACTURERS), with_domain("raw_products", body=SQL_MANUFACTURERS)),
    Case("mart_products", _view(marts.PRODUCTS), with_domain("raw_products", body=SQL_PRODUCTS)),
    Case("mart_customers", _view(marts.CUSTOMERS), with_domain("raw_customers", body=SQL_CUSTOMERS)),
    Case("mart_stores", _view(marts.STORES), with_domain("raw_stores", body=SQL_STORES)),
    Case("mart_purchases", _view(marts.PURCHASES), with_domain("raw_purchases", body=SQL_PURCHASES)),
    Case(
        "explode_items",
        _exploded,
        with_domain(
            "raw_purchases",
            body=f"SELECT record_id, purchase_id, product_id, quantity, unit, price_per_unit, total_price FROM ({SQL_ITEMS})",
        ),
    ),
    Case(
        "rejected_purchases",
        _purchase_rejects,
        with_domain(
            "raw_purchases",
            body=f""", i AS ({SQL_ITEMS}), r AS (
                SELECT unnest([
                    CASE WHEN coalesce(TRY_CAST(quantity AS FLOAT), 0) <= 0 THEN 'quantity' END,
                    CASE WHEN coalesce(TRY_CAST(price_per_unit AS FLOAT), 0) <= 0 THEN 'price_per_unit' END,
                    CASE WHEN coalesce(unit, '') = '' THEN 'unit' END,
                    CASE WHEN coalesce(product_id, '') = '' THEN 'product_id' END,
                    CASE WHEN coalesce(TRY_CAST(total_amount AS DECIMAL(18,2)), 0) <= 0 THEN 'total_amount' END,
                    CASE WHEN coalesce(purchase_id, '') = '' THEN 'purchase_id' END,
                    CASE WHEN coalesce(customer_customer_id, '') = '' THEN 'customer_customer_id' END]) AS rule
                FROM i)
                SELECT rule, count(*) AS rejected_rows FROM r WHERE rule IS NOT NULL GROUP BY rule""",
        ),
    ),
    Case(
        "surrogate_key",
        lambda s: s.domain("raw_customers").select(
            "customer_id",
            marts.place_key("purchase_location").alias("purchase_address_id"),
            marts.delivery_key("delivery_address").alias("delivery_address_id"),
            keys.normalized_key("first_name", "last_name").alias("name_key"),
        ),
        with_domain(
            "raw_customers",
            body=f"""SELECT customer_id, {_sql_key_of("purchase_location", PLACE)} AS purchase_address_id,
                {_sql_key_of("delivery_address", DELIVERY)} AS delivery_address_id,
                {sql_key(*sql_normal("first_name", "last_name"))} AS name_key FROM raw_customers""",
        ),
    ),
    Case(
        "typed_casts",
        _typed,
        with_domain(
            "raw_products",
            body="""SELECT product_id, TRY_CAST(kbju_calories AS DOUBLE) AS calories,
                CAST(TRY_CAST(kbju_protein AS FLOAT) AS DOUBLE) AS protein, TRY_CAST(price AS DECIMAL(18,2)) AS price,
                TRY_CAST(expiry_days AS SMALLINT) AS expiry_days, TRY_CAST(is_organic AS BOOLEAN) AS is_organic
                FROM raw_products""",
        ),
    ),
    Case(
        "parse_datetime",
        _times,
        """SELECT o_orderkey, CASE WHEN o_orderkey % 5 < 4
                  THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL '37230' SECOND END AS moment,
                  CAST(o_orderdate AS DATE) AS day FROM orders""",
    ),
    Case(
        "filter_non_blank",
        lambda s: s.domain("raw_customers").filter(p.non_blank(F.col("purchase_location_street"))
            & p.non_blank(F.col("email"))).select("customer_id", "purchase_location_street", "email"),
        with_domain(
            "raw_customers",
            body="SELECT customer_id, purchase_location_street, email FROM raw_customers WHERE "
            + sql_filled("purchase_location_street", "email"),
        ),
    ),
    Case(
        "filter_regex",
        lambda s: s.domain("raw_products")
        .filter(p.is_tax_number(F.col("manufacturer_inn")))
        .select("product_id", "manufacturer_inn"),
        with_domain(
            "raw_products",
            body="SELECT product_id, manufacturer_inn FROM raw_products "
            "WHERE regexp_full_match(manufacturer_inn, '[0-9]{10}')",
        ),
    ),
    Case(
        "filter_positive",
        lambda s: s.domain("raw_products")
        .filter(p.positive_money(F.col("price")) & p.positive_real(F.col("kbju_protein")))
        .select("product_id", "price", "kbju_protein"),
        with_domain(
            "raw_products",
            body="SELECT product_id, price, kbju_protein FROM raw_products "
            "WHERE TRY_CAST(price AS DECIMAL(18,2)) > 0 AND TRY_CAST(kbju_protein AS FLOAT) > 0",
        ),
    ),
    Case(
        "filter_date_order",
        lambda s: s.domain("raw_customers")
        .filter(
            p.date_before(F.col("birth_date"), F.col("load_date"))
            & p.date_not_after(F.col("registration_date"), F.col("load_date"))
        )
        .select("customer_id", "birth_date", "registration_date"),
        with_domain(
            "raw_customers",
            body="SELECT customer_id, birth_date, registration_date FROM raw_customers "
            "WHERE CAST(birth_date AS DATE) < CAST(load_date AS DATE) "
            "AND CAST(CAST(registration_date AS TIMESTAMP) AS DATE) <= CAST(load_date AS DATE)",
        ),
    ),
    Case(
        "normalize_text",
        lambda s: s.table("documents").select("doc_id", text.normalize(F.col("text")).alias("text")),
        "SELECT doc_id, lower(trim(text)) AS text FROM documents",
    ),
    Case(
        "ltrim_charset",
        lambda s: s.domain("raw_products").select("product_id", text.category(F.col("group")).alias("category_name")),
        with_domain(
            "raw_products",
            body=f"SELECT product_id, {sql_category(chr(34) + 'group' + chr(34))} AS category_name FROM raw_products",
        ),
    ),
    Case(
        "array_transform",
        lambda s: s.domain("raw_stores").select(
            "store_id",
            F.posexplode(F.transform(text.split_list(F.col("categories")), text.category)).alias("position", "category"),
        ),
        with_domain(
            "raw_stores",
            body=f"""SELECT store_id, CAST(position - 1 AS INT) AS position, {sql_category("parts[position]")} AS category
                FROM (SELECT store_id, string_split(categories, '|') AS parts,
                      unnest(range(1, len(string_split(categories, '|')) + 1)) AS position FROM raw_stores)""",
        ),
    ),
]
