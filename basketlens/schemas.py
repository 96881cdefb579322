"""Schemas of the source documents, the RAW tables and the MART tables, as DDL text.

Fixed values: the names of fields, columns and tables.
"""

from __future__ import annotations

ENTITIES = ("customers", "stores", "products", "purchases")

CORRUPT = "_corrupt_record"


_PLACE = (
    "country: string, city: string, street: string, house: string, postal_code: string, "
    "coordinates: struct<latitude: double, longitude: double>"
)
_DELIVERY = "country: string, city: string, street: string, house: string, apartment: string, postal_code: string"
_NUTRITION = "calories: double, protein: double, fat: double, carbohydrates: double"
_MAKER = "name: string, country: string, website: string, inn: string"
_LINEAGE = "load_date string, record_source string"

#: nested documents as they are published: source fields, the source id and the load lineage
DOCUMENTS: dict[str, str] = {
    "customers": (
        "_id string, customer_id string, first_name string, last_name string, email string, phone string, "
        "birth_date string, gender string, registration_date string, is_loyalty_member boolean, "
        f"loyalty_card_number string, purchase_location struct<{_PLACE}>, delivery_address struct<{_DELIVERY}>, "
        "preferences struct<preferred_language: string, preferred_payment_method: string, "
        f"receive_promotions: boolean>, {_LINEAGE}"
    ),
    "stores": (
        "_id string, store_id string, store_name string, store_network string, store_type_description string, "
        "type string, categories array<string>, manager struct<name: string, phone: string, email: string>, "
        f"location struct<{_PLACE}>, opening_hours struct<mon_fri: string, sat: string, sun: string>, "
        "accepts_online_orders boolean, delivery_available boolean, warehouse_connected boolean, "
        f"last_inventory_date string, {_LINEAGE}"
    ),
    "products": (
        "_id string, id string, name string, `group` string, description string, "
        f"kbju struct<{_NUTRITION}>, price double, unit string, origin_country string, expiry_days int, "
        f"is_organic boolean, barcode string, manufacturer struct<{_MAKER}>, {_LINEAGE}"
    ),
    "purchases": (
        "_id string, purchase_id string, "
        "customer struct<customer_id: string, first_name: string, last_name: string>, "
        f"store struct<store_id: string, store_name: string, store_network: string, location: struct<{_PLACE}>>, "
        "items array<struct<product_id: string, name: string, category: string, quantity: double, unit: string, "
        f"price_per_unit: double, total_price: double, kbju: struct<{_NUTRITION}>, manufacturer: struct<{_MAKER}>>>, "
        f"total_amount double, payment_method string, is_delivery boolean, delivery_address struct<{_DELIVERY}>, "
        f"purchase_datetime string, {_LINEAGE}"
    ),
}

#: the id of the source record is renamed on the way into RAW, and the product's own id with it
RAW_RENAMES: dict[str, dict[str, str]] = {
    "customers": {"_id": "record_id"},
    "stores": {"_id": "record_id"},
    "products": {"_id": "record_id", "id": "product_id"},
    "purchases": {"_id": "record_id"},
}

#: columns the flattened purchase documents hold beyond the RAW table
RAW_OMITTED: dict[str, tuple[str, ...]] = {
    "purchases": ("store_location_country", "delivery_address_country"),
}

#: the column a RAW table is ordered by after load_date
RAW_ORDER = {
    "customers": "customer_id",
    "stores": "store_id",
    "products": "product_id",
    "purchases": "purchase_id",
}

MART: dict[str, str] = {
    "address": (
        "address_id bigint, country string, city string, street string, house string, apartment string, "
        "postal_code string, coordinates_latitude double, coordinates_longitude double, load_date timestamp"
    ),
    "manufacturers": (
        "manufacturer_id bigint, manufacturer_name string, country string, website string, inn string, "
        "load_date timestamp"
    ),
    "products": (
        "product_id string, product_name string, category_name string, description string, kbju_calories float, "
        "kbju_protein float, kbju_fat float, kbju_carbohydrates float, unit string, price decimal(18,2), "
        "origin_country string, expiry_days smallint, is_organic boolean, barcode string, manufacturer_id bigint, "
        "load_date timestamp"
    ),
    "customers": (
        "customer_id string, first_name string, last_name string, email string, phone string, birth_date date, "
        "gender string, registration_date timestamp, is_loyalty_member boolean, loyalty_card_number string, "
        "purchase_address_id bigint, delivery_address_id bigint, preferences_preferred_language string, "
        "preferences_preferred_payment_method string, preferences_receive_promotions boolean, load_date timestamp"
    ),
    "stores": (
        "store_id string, store_name string, store_network string, store_type_description string, type string, "
        "categories array<string>, manager_name string, manager_phone string, manager_email string, "
        "address_id bigint, opening_hours_mon_fri string, opening_hours_sat string, opening_hours_sun string, "
        "accepts_online_orders boolean, delivery_available boolean, warehouse_connected boolean, "
        "last_inventory_date date, load_date timestamp"
    ),
    "purchases": (
        "purchase_id string, store_id string, customer_id string, product_id string, quantity float, unit string, "
        "price_per_unit decimal(18,2), total_item_price decimal(18,2), total_amount decimal(18,2), "
        "payment_method string, is_delivery boolean, delivery_address_id bigint, purchase_datetime timestamp, "
        "load_date timestamp"
    ),
}

#: what one row of a mart stands for; newer loads replace older ones under the same key
MART_KEYS: dict[str, tuple[str, ...]] = {
    "address": ("address_id",),
    "manufacturers": ("inn",),
    "products": ("product_id",),
    "customers": ("customer_id",),
    "stores": ("store_id",),
    "purchases": ("purchase_id", "product_id"),
}
