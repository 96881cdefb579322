"""Marts -> customer flags -> dated CSV."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from basketlens.config import FeatureConfig
from basketlens.operators.fact import PURCHASE_COLUMNS
from basketlens.operators.features import customer_features
from basketlens.session import scratch_scope, shuffles_dropped, staged
from basketlens.sinks.export import export_csv, result_name
from basketlens.sources.tables import current_mart
from basketlens.streaming.ingest import Lake, current_addresses


def report_of(
    current: Callable[[str], DataFrame], addresses: Callable[[DataFrame], DataFrame], config: FeatureConfig
) -> DataFrame:
    """The flags, from the current rows of each mart and the current addresses of some stores.

    The looked-up tables and the purchases are narrowed, versioned and staged once: each is read several times.
    """
    products = staged(current("products").select("product_id", "category_name", "is_organic"), "products")
    stores = staged(current("stores").select("store_id", "address_id"), "stores")
    address = staged(addresses(stores).select("address_id", "city"), "address")
    purchases = staged(current("purchases").select(*PURCHASE_COLUMNS), "purchases")
    return customer_features(current("customers"), purchases, products, stores, address, config)


def report(spark: SparkSession, lake: Lake, config: FeatureConfig) -> DataFrame:
    """The flags of the current customers of a lake.

    Of the current addresses, which are mostly those of customers, only the buckets of stores are read, and nothing of
    their history.
    """
    return report_of(
        lambda name: current_mart(spark, lake.mart(name), name), current_addresses(spark, lake).lookup, config
    )


def publish_report(spark: SparkSession, lake: Lake, target: str, config: FeatureConfig) -> str:
    """Write the report below ``target`` (any file system Spark can reach) and return its folder."""
    # the day is settled once, in UTC, for the name and for the flags
    config = replace(config, as_of=config.as_of or dt.datetime.now(dt.timezone.utc).date())
    path = f"{target}/{result_name(config.as_of)}"
    with scratch_scope(spark), shuffles_dropped(spark):
        export_csv(report(spark, lake, config), path, "customer_id")
    return path
