"""Flattening, JSON, lists, personal data."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.config import MaskingConfig
from basketlens.functions import masking, text
from basketlens.operators.flatten import flatten, with_lineage
from workload.adapter import Supplied
from workload.case import Case, with_domain

# The tables hold no real person; a deployment reads its secret from its own configuration.
SECRET = "secret of the test tables"
KEYED = MaskingConfig("keyed", SECRET)
LOADED_AT = dt.datetime(2001, 8, 2, 10, 0, 0)


def _supplier_documents(s: Supplied) -> DataFrame:
    """Suppliers as nested documents with a place, a flag and a list."""
    c = F.col
    nation = s.table("nation").join(s.table("region"), c("n_regionkey") == c("r_regionkey"))
    return (
        s.table("supplier")
        .join(nation, c("s_nationkey") == c("n_nationkey"))
        .select(
            c("s_suppkey").alias("_id"),
            c("s_name").alias("store_name"),
            F.struct(
                c("r_name").alias("country"),
                c("n_name").alias("city"),
                F.struct((c("n_nationkey") * 2).alias("latitude"), c("n_regionkey").alias("longitude")).alias(
                    "coordinates"
                ),
            ).alias("location"),
            (c("s_suppkey") % 2 == 0).alias("delivery_available"),
            F.array(c("r_name"), c("n_name")).alias("categories"),
            F.when(c("s_suppkey") % 3 > 0, F.struct(c("s_name").alias("name"))).alias("manager"),
        )
    )


FLAT_SQL = """
    SELECT CAST(s_suppkey AS VARCHAR) AS _id, s_name AS store_name, r_name AS location_country,
           n_name AS location_city, CAST(n_nationkey * 2 AS VARCHAR) AS location_coordinates_latitude,
           CAST(n_regionkey AS VARCHAR) AS location_coordinates_longitude,
           CASE WHEN s_suppkey % 2 = 0 THEN 'True' ELSE 'False' END AS delivery_available,
           r_name || '|' || n_name AS categories, CASE WHEN s_suppkey % 3 > 0 THEN s_name END AS manager_name
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

PHONE_SQL = """
    CASE WHEN regexp_full_match(translate(phone, ' ()-', ''), '\\+?[0-9]{11}')
         THEN regexp_replace(translate(phone, ' ()-', ''), '^\\+7', '8') END"""
EMAIL_SQL = "nullif(lower(replace(email, ' ', '')), '')"


def keyed_sql(value: str) -> str:
    inner, outer = masking.masking_keys(SECRET)
    return f"sha256('{outer}' || sha256('{inner}' || {value}))"


def _contacts(s: Supplied) -> DataFrame:
    return s.domain("raw_customers").select("customer_id", "phone", "email")


def _nested_contacts(s: Supplied) -> DataFrame:
    """Contacts at the top, in an object and in a list of objects."""
    phone, email = F.col("phone"), F.col("email")
    return _contacts(s).select(
        F.col("customer_id").alias("_id"),
        "phone",
        F.struct(F.col("customer_id").alias("name"), email).alias("manager"),
        F.array(F.struct(phone, F.lit("work").alias("kind")), F.struct(F.lit("12345").alias("phone"), F.lit("home").alias("kind"))).alias(
            "contacts"
        ),
        F.array(email).alias("notes"),
    )


def _mask_nested(s: Supplied) -> DataFrame:
    masked = masking.mask_documents(_nested_contacts(s), KEYED)
    return masked.select(
        "_id",
        "phone",
        F.col("manager.name").alias("manager_name"),
        F.col("manager.email").alias("manager_email"),
        F.col("contacts")[0]["phone"].alias("first_contact"),
        F.col("contacts")[1]["phone"].alias("second_contact"),
        F.col("contacts")[0]["kind"].alias("first_kind"),
        F.col("notes")[0].alias("note"),
    )


def _masked(config: MaskingConfig):
    return lambda s: masking.mask_documents(_contacts(s), config)


def _mask_random(s: Supplied) -> DataFrame:
    """Random tokens differ in every run, so what is compared is their form and that none is a plain digest."""

    def form(token: str, value: Column) -> list[Column]:
        c = F.col(token)
        return [
            c.rlike(r"\A[0-9a-f]{32}\z").alias(f"{token}_is_token"),
            (c == F.md5(value)).alias(f"{token}_unsalted"),
        ]

    cleaned = _contacts(s).select(
        "customer_id",
        "phone",
        "email",
        text.clean_phone(F.col("phone")).alias("clean_phone"),
        text.clean_email(F.col("email")).alias("clean_email"),
    )
    masked = masking.mask_documents(cleaned, MaskingConfig("random"))
    return masked.select("customer_id", *form("phone", F.col("clean_phone")), *form("email", F.col("clean_email")))


def _items_roundtrip(s: Supplied) -> DataFrame:
    """Items as one-element lists of objects, written as JSON text and read back."""
    kind = "array<struct<product_id: bigint, quantity: double, price: decimal(18,2), note: string>>"
    items = F.array(
        F.struct(
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
            F.concat(F.lit('шт "'), F.col("l_returnflag"), F.lit('"\n🥖')).alias("note"),
        )
    )
    back = F.from_json(F.to_json(items), kind)
    return s.table("lineitem").select("l_orderkey", "l_linenumber", F.inline(back))


CASES = [
    Case("flatten_struct", lambda s: flatten(_supplier_documents(s)), FLAT_SQL),
    Case(
        "array_join_split",
        lambda s: _supplier_documents(s)
        .select("_id", text.join_list(F.col("categories")).alias("joined"))
        .select(
            "_id",
            "joined",
            text.split_list(F.col("joined"))[1].alias("second"),
            F.size(text.split_list(F.col("joined"))).alias("parts"),
        ),
        """SELECT s_suppkey AS _id, r_name || '|' || n_name AS joined, n_name AS second, CAST(2 AS INTEGER) AS parts
           FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    ),
    Case(
        "items_json_roundtrip",
        _items_roundtrip,
        """SELECT l_orderkey, l_linenumber, l_partkey AS product_id, l_quantity AS quantity,
                  CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
                  'шт "' || l_returnflag || '"' || chr(10) || '🥖' AS note FROM lineitem""",
    ),
    Case(
        "json_field",
        lambda s: s.table("events").select(
            "event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k")
        ),
        "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    ),
    Case(
        "lineage_columns",
        lambda s: with_lineage(s.table("orders"), LOADED_AT, "shop_database", "purchases").select(
            "o_orderkey", "load_date", "record_source"
        ),
        "SELECT o_orderkey, '2001-08-02T10:00:00' AS load_date, 'mongo_db:shop_database_purchases' AS record_source "
        "FROM orders",
    ),
    Case(
        "clean_phone",
        lambda s: _contacts(s).select("customer_id", "phone", text.clean_phone(F.col("phone")).alias("clean_phone")),
        with_domain("raw_customers", body=f"SELECT customer_id, phone, {PHONE_SQL} AS clean_phone FROM raw_customers"),
    ),
    Case(
        "clean_email",
        lambda s: _contacts(s).select("customer_id", "email", text.clean_email(F.col("email")).alias("clean_email")),
        with_domain("raw_customers", body=f"SELECT customer_id, email, {EMAIL_SQL} AS clean_email FROM raw_customers"),
    ),
    Case(
        "mask_keyed",
        _masked(KEYED),
        with_domain(
            "raw_customers",
            body=f"SELECT customer_id, {keyed_sql(PHONE_SQL)} AS phone, {keyed_sql(EMAIL_SQL)} AS email FROM raw_customers",
        ),
    ),
    Case(
        "mask_random",
        _mask_random,
        with_domain(
            "raw_customers",
            body=f"""SELECT customer_id,
                CASE WHEN {PHONE_SQL} IS NOT NULL THEN true END AS phone_is_token,
                CASE WHEN {PHONE_SQL} IS NOT NULL THEN false END AS phone_unsalted,
                CASE WHEN {EMAIL_SQL} IS NOT NULL THEN true END AS email_is_token,
                CASE WHEN {EMAIL_SQL} IS NOT NULL THEN false END AS email_unsalted FROM raw_customers""",
        ),
    ),
    Case(
        "mask_nested",
        _mask_nested,
        with_domain(
            "raw_customers",
            body=f"""SELECT customer_id AS _id, {keyed_sql(PHONE_SQL)} AS phone, customer_id AS manager_name,
                {keyed_sql(EMAIL_SQL)} AS manager_email, {keyed_sql(PHONE_SQL)} AS first_contact,
                CAST(NULL AS VARCHAR) AS second_contact, 'work' AS first_kind, email AS note FROM raw_customers""",
        ),
    ),
]
