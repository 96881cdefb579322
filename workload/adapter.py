"""The retail domain laid over the supplied tables.

Each entry of ``DOMAIN`` is one SELECT that Spark SQL and the checking engine both accept: plain
projections and joins that only give the supplied columns the names and text forms of the domain.
Operators are never part of it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from basketlens.config import CategoryRoles, FeatureConfig
from basketlens.session import prepare

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

AS_OF = dt.date(2001, 8, 2)

# Windows six times the usual and thresholds near the quantiles of the order totals, so that the flags
# take both values on these tables.
CONFIG = FeatureConfig(
    as_of=AS_OF,
    roles=CategoryRoles(dairy="economy", fruit="medium", vegetables="standard", meat="promo", bakery="small"),
    week_days=42,
    fortnight_days=84,
    month_days=180,
    quarter_days=540,
    bulk_above=300_000,
    low_below=150_000,
    spender_from=400_000,
)

_GEO = """
    JOIN {nation} ON n_nationkey = {key}
    JOIN {region} ON r_regionkey = n_regionkey
"""

DOMAIN: dict[str, str] = {
    # ---- marts, as the feature job reads them
    "customers": """
        SELECT CAST(c_custkey AS STRING) AS customer_id,
               CAST(DATE '2001-08-02' - CAST(c_custkey % 1500 AS INT) AS TIMESTAMP_NTZ) AS registration_date,
               c_acctbal > 0 AS is_loyalty_member
        FROM {customer}""",
    "purchases": """
        SELECT CAST(o_orderkey AS STRING) AS purchase_id,
               CAST(l_suppkey AS STRING) AS store_id,
               CAST(o_custkey AS STRING) AS customer_id,
               CAST(l_partkey AS STRING) AS product_id,
               CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount,
               CASE o_orderstatus WHEN 'F' THEN 'cash' WHEN 'O' THEN 'card' ELSE 'other' END AS payment_method,
               l_returnflag = 'R' AS is_delivery,
               o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey % 24 AS INT) AS purchase_datetime,
               CASE WHEN o_orderdate >= TIMESTAMP_NTZ '2000-01-01 00:00:00' THEN DATE '2001-08-02'
                    ELSE DATE '1999-12-31' END AS load_date
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "products": """
        SELECT CAST(p_partkey AS STRING) AS product_id,
               lower(p_type) AS category_name,
               p_size % 2 = 0 AS is_organic
        FROM {part}""",
    "stores": """
        SELECT CAST(s_suppkey AS STRING) AS store_id, CAST(s_nationkey AS BIGINT) AS address_id FROM {supplier}""",
    "address": """
        SELECT CAST(n_nationkey AS BIGINT) AS address_id, n_name AS city FROM {nation}""",
    # ---- RAW tables: everything is text, some of it unusable
    "raw_customers": """
        SELECT 'rec-' || CAST(c_custkey AS STRING) AS record_id,
               'cus-' || CAST(c_custkey AS STRING) AS customer_id,
               CASE WHEN c_custkey % 31 = 0 THEN '' ELSE '  ' || upper(c_name) || ' ' END AS first_name,
               ' ИВАНОВ-' || c_mktsegment || '  ' AS last_name,
               CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN ' User.' || CAST(c_custkey AS STRING) || ' @Mail.ORG '
                    WHEN 2 THEN 'user' || CAST(c_custkey % 100 AS STRING) || '@mail.org' END AS email,
               CASE c_custkey % 7
                    WHEN 0 THEN '+7 (' || lpad(CAST(c_custkey % 1000 AS STRING), 3, '0') || ') 412-52-86'
                    WHEN 1 THEN '8 (528) ' || lpad(CAST(c_custkey % 1000 AS STRING), 3, '0') || '-92-64'
                    WHEN 2 THEN '+7' || lpad(CAST(c_custkey AS STRING), 10, '9')
                    WHEN 3 THEN '+1 (480) 396-52' || lpad(CAST(c_custkey % 100 AS STRING), 2, '0')
                    WHEN 4 THEN CAST(c_custkey AS STRING)
                    WHEN 5 THEN '7 827 109 10' || lpad(CAST(c_custkey % 100 AS STRING), 2, '0') END AS phone,
               CAST(DATE '1960-01-01' + CAST(c_custkey * 11 % 16000 AS INT) AS STRING) AS birth_date,
               CASE WHEN c_custkey % 2 = 0 THEN ' Male' ELSE 'FEMALE ' END AS gender,
               CAST(DATE '1998-01-01' + CAST(c_custkey * 7 % 1400 AS INT) AS STRING) || 'T10:15:30.123456'
                   AS registration_date,
               CASE WHEN c_acctbal > 0 THEN 'True' ELSE 'False' END AS is_loyalty_member,
               CASE WHEN c_custkey % 7 = 0 THEN '' ELSE 'LOYAL-' || CAST(c_custkey AS STRING) END
                   AS loyalty_card_number,
               r_name AS purchase_location_country,
               ' ' || n_name || ' ' AS purchase_location_city,
               CASE WHEN c_custkey % 13 = 0 THEN '' ELSE c_mktsegment END AS purchase_location_street,
               CAST(c_custkey % 50 AS STRING) AS purchase_location_house,
               CAST(100000 + c_nationkey AS STRING) AS purchase_location_postal_code,
               CAST(CAST(c_nationkey AS DECIMAL(9,4)) * 1.5 AS STRING) AS purchase_location_coordinates_latitude,
               CASE WHEN c_custkey % 17 = 0 THEN 'n/a' ELSE CAST(c_nationkey * 2 AS STRING) END
                   AS purchase_location_coordinates_longitude,
               r_name AS delivery_address_country,
               n_name AS delivery_address_city,
               'Улица ' || c_mktsegment AS delivery_address_street,
               CAST(c_custkey % 50 AS STRING) AS delivery_address_house,
               CASE WHEN c_custkey % 9 <> 0 THEN CAST(c_custkey % 9 AS STRING) END AS delivery_address_apartment,
               CASE WHEN c_custkey % 19 <> 0 THEN CAST(100000 + c_nationkey AS STRING) END
                   AS delivery_address_postal_code,
               ' RU' AS preferences_preferred_language,
               CASE WHEN c_custkey % 3 = 0 THEN 'CARD' ELSE 'cash ' END AS preferences_preferred_payment_method,
               CASE WHEN c_custkey % 5 = 0 THEN 'True' ELSE 'False' END AS preferences_receive_promotions,
               TIMESTAMP_NTZ '2001-08-02 00:00:00' AS load_date,
               'mongo_db:shop_database_customers' AS record_source
        FROM {customer}"""
    + _GEO.replace("{key}", "c_nationkey"),
    "raw_products": """
        SELECT 'rec-' || CAST(p_partkey AS STRING) AS record_id,
               'prd-' || CAST(p_partkey AS STRING) AS product_id,
               ' ' || upper(p_name) AS name,
               CASE p_partkey % 6 WHEN 0 THEN '🥖 ' WHEN 1 THEN '🥩 ' WHEN 2 THEN '🥛 ' WHEN 3 THEN '🍏 '
                    WHEN 4 THEN '🥦 ' ELSE '' END || p_type || ', Овощи' AS "group",
               '  Описание ' || p_brand AS description,
               CAST(CAST(p_size AS DECIMAL(9,1)) * 10.5 AS STRING) AS kbju_calories,
               CASE WHEN p_partkey % 29 = 0 THEN '-' ELSE CAST(p_size * 2 AS STRING) END AS kbju_protein,
               CAST(p_size AS STRING) || '.5' AS kbju_fat,
               CAST(p_size % 7 AS STRING) || '.25' AS kbju_carbohydrates,
               CASE WHEN p_partkey % 11 = 0 THEN '-1' WHEN p_partkey % 17 = 0 THEN 'abc'
                    ELSE CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS STRING) END AS price,
               CASE WHEN p_partkey % 19 = 0 THEN '' ELSE ' ШТ ' END AS unit,
               'Россия ' AS origin_country,
               CASE WHEN p_partkey % 37 = 0 THEN '99999' ELSE CAST(p_size AS STRING) END AS expiry_days,
               CASE WHEN p_size % 2 = 0 THEN 'True' ELSE 'False' END AS is_organic,
               CASE WHEN p_partkey % 23 <> 0 THEN lpad(CAST(p_partkey AS STRING), 13, '4') END AS barcode,
               CASE WHEN p_partkey % 41 = 0 THEN '' ELSE ' ООО ' || p_brand END AS manufacturer_name,
               'РОССИЯ' AS manufacturer_country,
               'https://' || lower(p_brand) || '.example' AS manufacturer_website,
               lpad(CAST(p_partkey % 25 AS STRING), CASE WHEN p_partkey % 5 = 0 THEN 9 ELSE 10 END, '0')
                   AS manufacturer_inn,
               TIMESTAMP_NTZ '2001-08-02 00:00:00' AS load_date,
               'mongo_db:shop_database_products' AS record_source
        FROM {part}""",
    "raw_stores": """
        SELECT 'rec-' || CAST(s_suppkey AS STRING) AS record_id,
               'store-' || CAST(s_suppkey AS STRING) AS store_id,
               CASE WHEN s_suppkey % 23 = 0 THEN '' ELSE ' Магазин ' || s_name || ' ' END AS store_name,
               CASE WHEN s_suppkey % 3 = 0 THEN 'БОЛЬШАЯ' ELSE 'Маленькая' END AS store_network,
               ' Супермаркет ' AS store_type_description,
               'offline' AS type,
               CASE s_suppkey % 3 WHEN 0 THEN '🥖 ECONOMY|🥩 MEDIUM|🥛 Promo' WHEN 1 THEN '🍏 SMALL|🥦 Large'
                    ELSE 'Standard' END AS categories,
               'Менеджер ' || CAST(s_suppkey % 10 AS STRING) AS manager_name,
               '8' || lpad(CAST(s_suppkey AS STRING), 10, '0') AS manager_phone,
               'm' || CAST(s_suppkey AS STRING) || '@mail.org' AS manager_email,
               r_name AS location_country,
               n_name AS location_city,
               CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE 'Проспект ' || CAST(s_suppkey % 11 AS STRING) END
                   AS location_street,
               CAST(s_suppkey % 90 AS STRING) AS location_house,
               CAST(200000 + s_nationkey AS STRING) AS location_postal_code,
               CAST(s_nationkey AS STRING) || '.5' AS location_coordinates_latitude,
               '-' || CAST(s_nationkey AS STRING) || '.25' AS location_coordinates_longitude,
               '09:00-21:00' AS opening_hours_mon_fri,
               '10:00-20:00' AS opening_hours_sat,
               '10:00-18:00' AS opening_hours_sun,
               'True' AS accepts_online_orders,
               CASE WHEN s_suppkey % 2 = 0 THEN 'True' ELSE 'False' END AS delivery_available,
               CASE WHEN s_suppkey % 5 = 0 THEN 'maybe' ELSE 'False' END AS warehouse_connected,
               CAST(DATE '2001-01-01' + CAST(s_suppkey % 200 AS INT) AS STRING) AS last_inventory_date,
               TIMESTAMP_NTZ '2001-08-02 00:00:00' AS load_date,
               'mongo_db:shop_database_stores' AS record_source
        FROM {supplier}"""
    + _GEO.replace("{key}", "s_nationkey"),
    # One document per line item, holding that item and a free gift whose price of zero is refused.
    "raw_purchases": """
        SELECT 'rec-' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS record_id,
               CASE WHEN l_orderkey % 43 = 0 THEN '' ELSE 'ord-' || CAST(l_orderkey AS STRING) END AS purchase_id,
               CASE WHEN o_custkey % 29 <> 0 THEN 'cus-' || CAST(o_custkey AS STRING) END AS customer_customer_id,
               'store-' || CAST(l_suppkey AS STRING) AS store_store_id,
               CASE WHEN l_orderkey % 97 = 0 THEN '[]'
                    WHEN l_orderkey % 101 = 0 THEN '[{{"product_id": '
                    ELSE '[{{"product_id": "' || CASE WHEN l_partkey % 53 = 0 THEN ''
                                                    ELSE 'prd-' || CAST(l_partkey AS STRING) END
                         || '", "quantity": ' || CAST(CAST(l_quantity AS INT) AS STRING)
                         || CASE WHEN l_linenumber % 2 = 0 THEN '' ELSE '.5' END || ', "shelf": {{"row": 7}}'
                         || ', "unit": "' || CASE WHEN l_linenumber % 2 = 0 THEN 'ШТ ' ELSE ' kg' END
                         || '", "price_per_unit": ' || CASE WHEN l_linenumber % 3 = 0 THEN '"' ELSE '' END
                         || CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING)
                         || CASE WHEN l_linenumber % 3 = 0 THEN '"' ELSE '' END
                         || ', "total_price": ' || CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 2 AS STRING)
                         || '}}, {{"product_id": "gift-' || CAST(l_linenumber AS STRING)
                         || '", "quantity": 1, "unit": "шт", "price_per_unit": 0, "total_price": 0}}]'
                    END AS items,
               CASE WHEN l_orderkey % 59 = 0 THEN '0' WHEN l_orderkey % 61 = 0 THEN 'unknown'
                    WHEN l_orderkey % 67 = 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 1000 AS STRING)
                    ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) END AS total_amount,
               CASE o_orderstatus WHEN 'F' THEN ' CASH' WHEN 'O' THEN 'Card ' ELSE 'Other' END AS payment_method,
               CASE WHEN l_returnflag = 'R' THEN 'True' ELSE 'False' END AS is_delivery,
               'City ' || CAST(o_custkey % 25 AS STRING) AS delivery_address_city,
               'УЛИЦА' AS delivery_address_street,
               CAST(o_custkey % 50 AS STRING) AS delivery_address_house,
               CASE WHEN o_custkey % 9 <> 0 THEN CAST(o_custkey % 9 AS STRING) END AS delivery_address_apartment,
               CAST(100000 + o_custkey % 25 AS STRING) AS delivery_address_postal_code,
               CAST(CAST(o_orderdate AS DATE) AS STRING) || 'T' || lpad(CAST(o_orderkey % 24 AS STRING), 2, '0')
                   || ':30:15.654321' AS purchase_datetime,
               TIMESTAMP_NTZ '2001-08-02 00:00:00' AS load_date
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
}


def domain_sql(name: str) -> str:
    """The SELECT of a domain table for the checking engine, where the tables are views by name."""
    text = DOMAIN[name].format(**{t: t for t in TABLES})
    return text.replace("TIMESTAMP_NTZ", "TIMESTAMP")


class Supplied:
    """The supplied tables of one folder, and the domain tables over them."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = prepare(spark)
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def domain(self, name: str) -> DataFrame:
        text = DOMAIN[name].replace('"group"', "`group`")
        used = {t: self.table(t) for t in TABLES if "{" + t + "}" in text}
        return self.spark.sql(text, **used)

    def marts(self) -> dict[str, DataFrame]:
        return {name: self.domain(name) for name in ("customers", "purchases", "products", "stores", "address")}
