"""Reads, writes and streams: each writes below the session's shared scratch folder and reads back."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens import schemas
from basketlens.config import MaskingConfig
from basketlens.operators import dedup
from basketlens.operators.features import FLAG_NAMES, customer_features
from basketlens.operators.marts import ADDRESS_FROM_DELIVERY, ADDRESS_FROM_PURCHASE_LOCATION, ADDRESS_FROM_STORES
from basketlens.plans import daily
from basketlens.plans.publish import publish
from basketlens.session import scratch_path
from basketlens.sinks.export import export_csv, read_csv
from basketlens.sinks.messages import to_messages
from basketlens.sinks.retention import expire, rewrite_boundary
from basketlens.sinks.tables import write_monthly
from basketlens.sources.documents import readable, scan_collection, scan_files, scan_json
from basketlens.sources.tables import newest_monthly, read_batches, read_mart, read_monthly
from basketlens.sources.topics import FileTopics
from basketlens.streaming.batches import followed
from basketlens.streaming.ingest import Lake, append_batches, ingest, route, start
from workload.adapter import AS_OF, CONFIG, Supplied
from workload.case import Case, plain_times, with_domain
from workload.features import RAW_CONFIG, flags_sql, newest_purchases, report_sql
from workload.marts import (
    SQL_ADDRESS,
    SQL_CUSTOMERS,
    SQL_MANUFACTURERS,
    SQL_PRODUCTS,
    SQL_PURCHASES,
    SQL_STORE_ADDRESS,
    SQL_STORES,
    comparable_mart,
    sql_delivery_address,
)
from workload.shaping import EMAIL_SQL, KEYED, PHONE_SQL, keyed_sql

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _json_scan(s: Supplied) -> DataFrame:
    """Orders written as JSON documents, read with a schema."""
    path = scratch_path(s.spark, "json")
    orders = s.table("orders")
    orders.write.json(path)
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    return readable(scan_json(s.spark, path, schema, multi_line=False))


def _messages(s: Supplied) -> DataFrame:
    """Orders as messages, the fields read back from the text."""
    read_back = F.from_json("value", "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double")
    return to_messages(s.table("orders")).select(read_back.alias("d")).select("d.*")


def _written_monthly(s: Supplied) -> tuple[str, str]:
    """Line items as a monthly table: its folder and schema."""
    path = scratch_path(s.spark, "monthly")
    items = s.table("lineitem").withColumnRenamed("l_shipdate", "load_date")
    write_monthly(items, path, "l_orderkey")
    return path, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in items.schema.fields)


def _monthly(s: Supplied) -> DataFrame:
    return read_monthly(s.spark, *_written_monthly(s))


def _monthly_newest(s: Supplied) -> DataFrame:
    return newest_monthly(s.spark, *_written_monthly(s))


def _retention_delete(s: Supplied) -> DataFrame:
    """Written, expired months deleted, and the rest read back through the filter of readers."""
    path, schema = _written_monthly(s)
    expire(s.spark, path, AS_OF)
    return dedup.retained(read_monthly(s.spark, path, schema), AS_OF, partition_column="load_month")


def _retention_rewrite(s: Supplied) -> DataFrame:
    """Written, expired months deleted, expired rows of the oldest month rewritten away; read back without any filter."""
    path, schema = _written_monthly(s)
    expire(s.spark, path, AS_OF)
    rewrite_boundary(s.spark, path, AS_OF)
    return read_monthly(s.spark, path, schema)


def _address_upsert(s: Supplied) -> DataFrame:
    """Addresses of customers, then of stores with a later load of some customers, each load twice as after a lost commit.
    What a look-up of the stores' addresses finds is marked."""
    lake = Lake(scratch_path(s.spark, "current"))
    table = lake.current("address")
    customers, stores = s.domain("raw_customers"), s.domain("raw_stores")
    later = customers.filter(F.col("customer_id").endswith("7")).withColumn("load_date", F.col("load_date") + F.make_dt_interval(F.lit(1)))
    first = ADDRESS_FROM_PURCHASE_LOCATION.build(customers).unionByName(ADDRESS_FROM_DELIVERY.build(customers))
    second = ADDRESS_FROM_STORES.build(stores).unionByName(ADDRESS_FROM_DELIVERY.build(later))
    for rows, applied in ((first, {"load": 0}), (first, {"load": 0}), (second, {"load": 1}), (second, {"load": 1})):
        table.upsert(rows, applied)
    wanted = ADDRESS_FROM_STORES.build(stores).select("address_id")
    of_stores = table.lookup(wanted).select(F.col("address_id").alias("found"))
    current = table.read(s.spark).join(of_stores, F.col("address_id") == F.col("found"), "left")
    return plain_times(current.select("address_id", "country", "city", "apartment", "load_date", F.col("found").isNotNull().alias("of_store")))


def _load_counts_observed(s: Supplied) -> DataFrame:
    """Documents of each collection, counted by the jobs that publish them."""
    topics = FileTopics(f"{scratch_path(s.spark, 'counted')}/topics")
    collections = {
        "customers": s.table("customer"),
        "stores": s.table("supplier"),
        "products": s.table("part"),
        "purchases": s.table("orders"),
        "refunds": s.table("orders").filter(F.col("o_orderstatus") == "none"),
    }
    sent = publish(collections, topics, KEYED, dt.datetime(2001, 8, 2))
    return s.spark.createDataFrame(sorted(sent.items()), "collection string, documents bigint")


def _stream_batches(s: Supplied) -> DataFrame:
    """Events in a file a week, a file a batch: first and last day of each batch, and its rows as Spark reports them."""
    root = scratch_path(s.spark, "weeks")
    weeks = s.table("events").withColumn("week", F.date_trunc("week", "ts").cast("date"))
    weeks.repartition("week").write.partitionBy("week").parquet(f"{root}/source")
    events = s.spark.readStream.schema(f"{EVENTS}, week date").option("maxFilesPerTrigger", 1).parquet(f"{root}/source")
    with followed(s.spark) as log:
        start(events, append_batches(f"{root}/events"), f"{root}/checkpoint", "weeks").awaitTermination()
    written = s.spark.read.schema(f"{EVENTS}, run string, batch_id bigint").parquet(f"{root}/events")
    days = written.groupBy("batch_id").agg(F.min(F.to_date("ts")).alias("first_day"), F.max(F.to_date("ts")).alias("last_day"))
    return days.join(log.rows(s.spark), "batch_id").select("first_day", "last_day", "n_rows")


def _json_scan_files(s: Supplied) -> DataFrame:
    """Suppliers as documents of several lines, one a file; some with the balance in quotes, some broken, some empty."""
    path = scratch_path(s.spark, "files")
    key = F.col("s_suppkey")
    quoted = F.when(key % 3 == 0, F.col("s_acctbal").cast("string"))
    plain = F.when(key % 3 != 0, F.col("s_acctbal"))
    whole = F.regexp_replace(F.to_json(F.struct(F.col("s_name"), plain.alias("plain"), quoted.alias("quoted"))), ",", ",\n  ")
    text = F.when(key % 50 == 1, "").when(key % 50 == 2, F.substring(whole, 1, 20)).when(key % 50 == 3, "[1]").otherwise(whole)
    # a file costs much more than its row: they are made by all cores, and put in place by the tasks that make them
    documents = s.table("supplier").select("s_suppkey", text.alias("value"))
    dealt = documents.repartition(4 * s.spark.sparkContext.defaultParallelism, "s_suppkey")
    writer = dealt.write.partitionBy("s_suppkey").option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    writer.text(path)
    found = scan_files(s.spark, path)
    field = lambda name: F.try_variant_get("document", f"$.{name}", "string")
    return found.select(
        F.regexp_extract("path", r"s_suppkey=(\d+)", 1).cast("bigint").alias("s_suppkey"),
        "fault",
        field("s_name").alias("s_name"),
        F.coalesce(field("plain"), field("quoted")).cast("double").alias("s_acctbal"),
    )


def _csv(s: Supplied) -> DataFrame:
    path = scratch_path(s.spark, "csv")
    export_csv(customer_features(**newest_purchases(s), config=CONFIG), path, "customer_id")
    flags = ", ".join(f"{name} boolean" for name in FLAG_NAMES)
    return read_csv(s.spark, path, f"customer_id string, {flags}")


def _event_stream(s: Supplied) -> DataFrame:
    return s.spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet").parquet(s.folder)


def _stream_ingest(s: Supplied) -> DataFrame:
    root = scratch_path(s.spark, "stream")
    start(_event_stream(s), append_batches(f"{root}/events"), f"{root}/checkpoint", "events").awaitTermination()
    return read_batches(s.spark, f"{root}/events", EVENTS)


def _stream_replay(s: Supplied) -> DataFrame:
    """Every batch of a stream twice, as after a lost commit: batches land on themselves."""
    root = scratch_path(s.spark, "replay")
    step = append_batches(f"{root}/events")

    def twice(batch: DataFrame, batch_id: int) -> None:
        step(batch, batch_id)
        step(batch, batch_id)

    start(_event_stream(s), twice, f"{root}/checkpoint", "replay").awaitTermination()
    return read_batches(s.spark, f"{root}/events", EVENTS)


def _stream_restart(s: Supplied) -> DataFrame:
    """A stream of several batches that is lost between the write of its second one and the commit, then goes on."""
    root = scratch_path(s.spark, "restart")
    s.table("events").repartition(5, "event_id").write.parquet(f"{root}/source")
    events = s.spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{root}/source")
    write, lost = append_batches(f"{root}/events"), []

    def failing(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        if batch_id == 1 and not lost:
            lost.append(batch_id)
            raise RuntimeError("lost after the write")

    for _ in range(2):
        try:
            start(events, failing, f"{root}/checkpoint", "restart").awaitTermination()
        except StreamingQueryException:
            if lost != [1]:
                raise
    return read_batches(s.spark, f"{root}/events", EVENTS)


def _stream_route(s: Supplied) -> DataFrame:
    root = scratch_path(s.spark, "route")
    events = _event_stream(s).withColumn("topic", F.col("event_type"))
    start(events, route(f"{root}/routed"), f"{root}/checkpoint", "route").awaitTermination()
    return read_batches(s.spark, f"{root}/routed", f"{EVENTS}, topic string")


# ---- the RAW rows of the domain turned back into source documents


def _documents(raw: DataFrame, entity: str) -> DataFrame:
    """RAW text columns nested into the document schema of their entity."""
    schema = T.StructType.fromDDL(schemas.DOCUMENTS[entity])
    origin = {new: old for old, new in schemas.RAW_RENAMES[entity].items()}
    source = {origin.get(c, c): c for c in raw.columns}

    def value(name: str, kind: T.DataType) -> Column:
        if isinstance(kind, T.StructType):
            return F.struct(*[value(f"{name}_{f.name}", f.dataType).alias(f.name) for f in kind.fields])
        if name not in source:
            return F.lit(None).cast(kind)
        c = F.col(f"`{source[name]}`")
        if name == "items":
            return F.try_parse_json(c)  # whatever the items hold
        return F.split(c, r"\|") if isinstance(kind, T.ArrayType) else c.try_cast(kind)

    kept = [f for f in schema.fields if f.name not in ("load_date", "record_source")]
    return raw.select(*[value(f.name, f.dataType).alias(f.name) for f in kept])


def _daily_run(s: Supplied) -> DataFrame:
    """Documents published, drained, reported as dated CSV, and that read back."""
    root = scratch_path(s.spark, "daily")
    topics, lake = FileTopics(f"{root}/topics", max_files_per_trigger=4), Lake(f"{root}/tables")
    collections = {e: _documents(s.domain(f"raw_{e}"), e) for e in schemas.ENTITIES}
    path = daily.run(s.spark, collections, topics, lake, f"{root}/reports", KEYED, RAW_CONFIG, dt.datetime(2001, 8, 2))
    return read_csv(s.spark, path, f"customer_id string, {', '.join(f'{name} boolean' for name in FLAG_NAMES)}")


def _daily_run_two_loads(s: Supplied) -> DataFrame:
    """Two days: first some of the documents, with other names of products, then all as they are. The report is that of the
    second day, addresses are those of both, and of RAW the rows of a year ago have gone."""
    root = scratch_path(s.spark, "days")
    topics, lake = FileTopics(f"{root}/topics"), Lake(f"{root}/tables")
    collections = {e: _documents(s.domain(f"raw_{e}"), e) for e in schemas.ENTITIES}
    id_ = {"customers": "customer_id", "stores": "store_id", "products": "id", "purchases": "purchase_id"}
    first = {e: df.filter(F.col(id_[e]).endswith("1") | F.col(id_[e]).endswith("4")) for e, df in collections.items()}
    first["products"] = first["products"].withColumn("group", F.lit("nothing"))
    path = ""
    for documents, day in ((first, dt.datetime(2000, 8, 1)), (collections, dt.datetime(2001, 8, 2))):
        path = daily.run(s.spark, documents, topics, lake, f"{root}/reports", KEYED, RAW_CONFIG, day)
    return read_csv(s.spark, path, f"customer_id string, {', '.join(f'{name} boolean' for name in FLAG_NAMES)}")


def filled_lake(s: Supplied) -> Lake:
    """Documents of all entities published and drained into RAW and MART tables."""
    root = scratch_path(s.spark, "lake")
    topics, lake = FileTopics(f"{root}/topics", max_files_per_trigger=4), Lake(f"{root}/tables")
    collections = {e: _documents(s.domain(f"raw_{e}"), e) for e in schemas.ENTITIES}
    publish(collections, topics, KEYED, dt.datetime(2001, 8, 2))
    ingest(s.spark, topics, lake)
    return lake


# columns compared per mart: all; contacts by their keyed digest, the row key first
COMPARED = {
    "address": "address_id country city street house apartment postal_code coordinates_latitude "
    "coordinates_longitude load_date",
    "manufacturers": "manufacturer_id manufacturer_name country website inn load_date",
    "products": "product_id product_name category_name description kbju_calories kbju_protein "
    "kbju_fat kbju_carbohydrates unit price origin_country expiry_days "
    "is_organic barcode manufacturer_id load_date",
    "customers": "customer_id first_name last_name email phone birth_date gender registration_date is_loyalty_member "
    "loyalty_card_number purchase_address_id delivery_address_id preferences_preferred_language "
    "preferences_preferred_payment_method preferences_receive_promotions load_date",
    "stores": "store_id store_name store_network store_type_description type categories manager_name manager_phone "
    "manager_email address_id opening_hours_mon_fri opening_hours_sat opening_hours_sun "
    "accepts_online_orders delivery_available warehouse_connected last_inventory_date load_date",
    "purchases": "purchase_id store_id customer_id product_id quantity unit price_per_unit total_item_price total_amount "
    "payment_method is_delivery delivery_address_id purchase_datetime load_date",
}

MART_SQL = {
    "address": SQL_ADDRESS,
    "manufacturers": SQL_MANUFACTURERS,
    "products": SQL_PRODUCTS,
    "customers": SQL_CUSTOMERS,
    "stores": SQL_STORES,
    "purchases": SQL_PURCHASES,
}


def _mv_incremental(s: Supplied) -> DataFrame:
    """Every row of every mart after the whole ingest, as its key and a digest of its columns."""
    lake = filled_lake(s)

    def digest(name: str) -> DataFrame:
        columns = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in COMPARED[name].split()]
        return comparable_mart(read_mart(s.spark, lake.mart(name), name)).select(
            F.lit(name).alias("mart"), columns[0].alias("row_key"), F.md5(F.concat_ws("|", *columns)).alias("row_digest")
        )

    return reduce(DataFrame.unionByName, [digest(name) for name in COMPARED])


def _mv_sql() -> str:
    def value(column: str) -> str:
        for kind, clean in (("phone", PHONE_SQL), ("email", EMAIL_SQL)):
            if column in (kind, f"manager_{kind}"):
                return keyed_sql(clean.replace(kind, column))
        return column

    def digest(name: str) -> str:
        columns = [f"coalesce(CAST({value(c)} AS VARCHAR), '~')" for c in COMPARED[name].split()]
        return (
            f"SELECT '{name}' AS mart, {columns[0]} AS row_key, md5(concat_ws('|', {', '.join(columns)})) AS row_digest "
            f"FROM ({MART_SQL[name]})"
        )

    return with_domain(
        "raw_customers",
        "raw_stores",
        "raw_products",
        "raw_purchases",
        body=" UNION ALL ".join(digest(name) for name in COMPARED),
    )


def _address_upsert_sql() -> str:
    return with_domain(
        "raw_customers",
        "raw_stores",
        body=f""", later AS (
            SELECT * REPLACE (load_date + INTERVAL 1 DAY AS load_date) FROM raw_customers WHERE ends_with(customer_id, '7')
        ), loads AS ({SQL_ADDRESS} UNION ALL {sql_delivery_address("later")})
        SELECT address_id, any_value(country) AS country, any_value(city) AS city, any_value(apartment) AS apartment,
               max(load_date) AS load_date, address_id IN (SELECT address_id FROM ({SQL_STORE_ADDRESS})) AS of_store
        FROM loads GROUP BY address_id""",
    )


CASES = [
    Case("json_scan", _json_scan, "SELECT * FROM orders"),
    Case(
        "snapshot_scan",
        lambda s: scan_collection(s.spark, f"{s.folder}/part.parquet"),
        "SELECT * FROM part",
    ),
    Case("to_json_messages", _messages, "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders"),
    Case(
        "monthly_partition_write",
        _monthly,
        "SELECT * EXCLUDE (l_shipdate), l_shipdate AS load_date, strftime(l_shipdate, '%Y%m') AS load_month FROM lineitem",
    ),
    Case(
        "monthly_latest_snapshot",
        _monthly_newest,
        "SELECT * EXCLUDE (l_shipdate), l_shipdate AS load_date, strftime(l_shipdate, '%Y%m') AS load_month "
        "FROM lineitem WHERE l_shipdate = (SELECT max(l_shipdate) FROM lineitem)",
    ),
    Case(
        "retention_delete",
        _retention_delete,
        "SELECT * EXCLUDE (l_shipdate), l_shipdate AS load_date, strftime(l_shipdate, '%Y%m') AS load_month "
        "FROM lineitem WHERE l_shipdate > DATE '2001-08-02' - INTERVAL '1' YEAR",
    ),
    Case(
        "retention_rewrite",
        _retention_rewrite,
        "SELECT * EXCLUDE (l_shipdate), l_shipdate AS load_date, strftime(l_shipdate, '%Y%m') AS load_month "
        "FROM lineitem WHERE l_shipdate > DATE '2001-08-02' - INTERVAL '1' YEAR",
    ),
    Case("address_upsert", _address_upsert, _address_upsert_sql()),
    Case(
        "load_counts_observed",
        _load_counts_observed,
        """SELECT 'customers' AS collection, count(*) AS documents FROM customer
           UNION ALL SELECT 'stores', count(*) FROM supplier UNION ALL SELECT 'products', count(*) FROM part
           UNION ALL SELECT 'purchases', count(*) FROM orders
           UNION ALL SELECT 'refunds', count(*) FROM orders WHERE o_orderstatus = 'none'""",
    ),
    Case(
        "stream_batches",
        _stream_batches,
        "SELECT min(CAST(ts AS DATE)) AS first_day, max(CAST(ts AS DATE)) AS last_day, count(*) AS n_rows "
        "FROM events GROUP BY date_trunc('week', ts)",
    ),
    Case(
        "json_scan_files",
        _json_scan_files,
        """SELECT s_suppkey, fault, CASE WHEN fault IS NULL THEN s_name END AS s_name,
                  CASE WHEN fault IS NULL THEN s_acctbal END AS s_acctbal
           FROM (SELECT *, CASE s_suppkey % 50 WHEN 1 THEN 'empty' WHEN 2 THEN 'not JSON' WHEN 3 THEN 'not an object' END AS fault
                 FROM supplier)""",
    ),
    Case("daily_run", _daily_run, report_sql()),
    Case("csv_export", _csv, flags_sql(newest=True)),
    Case("stream_ingest", _stream_ingest, "SELECT * FROM events"),
    Case("stream_replay_idempotent", _stream_replay, "SELECT * FROM events"),
    Case("stream_restart", _stream_restart, "SELECT * FROM events"),
    Case("daily_run_two_loads", _daily_run_two_loads, report_sql()),
    Case("mv_incremental", _mv_incremental, _mv_sql()),
    Case("stream_route", _stream_route, "SELECT *, event_type AS topic FROM events"),
]
