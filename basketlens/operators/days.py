"""What customers bought, as one row per customer and day that loads add to.

The flags of any as-of date come from these rows: windows are whole days, so a condition is kept without its window and
the window is laid over the days when the flags are asked for. A load brings the whole days of the customers it
touches and is merged into a `sinks.state.KeyedTable`; neither items nor purchases of earlier loads are read again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.config import FeatureConfig
from basketlens.operators.dedup import latest_by_key
from basketlens.operators.features import (
    FLAG_NAMES,
    as_of,
    asked,
    fingerprint_names,
    fingerprints_of,
    item_conditions,
    merged_fingerprints,
    several,
)
from basketlens.sinks.state import KeyedTable

KEYS = ("customer_id", "day")
#: Columns of which "some" and "several" are asked, and the one whose values are counted.
_FINGERPRINTS, _COUNTED = ("city", "store_id"), "category_name"

SCHEMA = (
    "customer_id string, day date, conditions bigint, condition_purchases array<bigint>, purchases bigint, "
    "single_item_purchases bigint, baskets bigint, items bigint, amount decimal(38,2), amount_rows bigint, "
    "amount_means double, means bigint, last_purchase timestamp, categories array<string>, "
    + ", ".join(f"{c} bigint" for column in _FINGERPRINTS for c in fingerprint_names(column))
    + ", load_date timestamp"
)


def table(path: str, buckets: int = 64) -> KeyedTable:
    """The day rows below a path; of a customer's day the newest load counts."""
    return KeyedTable(path, SCHEMA, KEYS, lambda df: latest_by_key(df, KEYS), buckets)


def _stand_ins() -> dict[str, Column]:
    """Each of KEYS as a value that is never null and tells null apart. Rows grouped by it lie as a join on it wants them;
    a null-safe join on the keys themselves would deal out and sort both sides anew."""
    return {
        "who": F.coalesce(F.concat(F.lit("="), "customer_id"), F.lit("")),
        "on": F.coalesce(F.unix_date("day"), F.lit(-(1 << 31))),  # no date is that early
    }


def day_rows(items: DataFrame, config: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Enriched items with their load date, as the rows of SCHEMA.

    Items are reduced to purchases first, combining before the shuffle, then to days. Categories are collected as sets, which
    hold each of a day's once before they come together. The rows hold what the roles and
    thresholds of config make of an item, but not its windows and as-of date. A purchase is of one day; items without a
    purchase id are one basket a day.
    """
    every = item_conditions(replace(config, as_of=dt.date(1000, 1, 1)))  # all windows are open
    bits = F.lit(0).cast("long")
    for i, name in enumerate(every):
        bits = bits.bitwiseOR(F.when(every[name], F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
    dated = items.withColumn("day", F.to_date("purchase_datetime"))
    found, by = dated.withColumns({"bits": bits, **_stand_ins()}), list(_stand_ins())
    prints = [c for column in _FINGERPRINTS for c in fingerprints_of(column)]
    baskets = found.groupBy(*by, "purchase_id").agg(
        F.bit_or("bits").alias("bits"),
        F.count("product_id").alias("items"),
        F.sum("total_amount").alias("amount"),
        F.count("total_amount").alias("amount_rows"),
        F.max("purchase_datetime").alias("last_purchase"),
        F.max("load_date").alias("load_date"),
        *prints,
    )
    known, mean = F.col("purchase_id").isNotNull(), F.try_divide("amount", "amount_rows")
    holding = [F.count_if(known & (F.col("bits").bitwiseAND(1 << i) != 0)) for i in range(len(every))]
    days = baskets.groupBy(*by).agg(
        F.bit_or("bits").alias("conditions"),
        F.array(*holding).alias("condition_purchases"),
        F.count("purchase_id").alias("purchases"),
        F.count_if(F.col("items") == 1).alias("single_item_purchases"),
        F.count(F.lit(1)).alias("baskets"),
        F.sum("items").alias("items"),
        F.sum("amount").alias("amount"),
        F.sum("amount_rows").alias("amount_rows"),
        F.sum(mean).alias("amount_means"),
        F.count(mean).alias("means"),
        F.max("last_purchase").alias("last_purchase"),
        F.max("load_date").alias("load_date"),
        *[c for column in _FINGERPRINTS for c in merged_fingerprints(column)],
    )
    lists = found.where(F.col(_COUNTED).isNotNull()).groupBy(*by).agg(F.sort_array(F.collect_set(_COUNTED)).alias("categories"))
    named = {
        "customer_id": F.when(F.col("who") != "", F.substr("who", F.lit(2))),
        "day": F.when(F.col("on") != -(1 << 31), F.date_from_unix_date("on")),
        "categories": F.coalesce("categories", F.array().cast("array<string>")),
    }
    kept = days.join(lists, by, "left").withColumns(named)
    return kept.to(kept.sparkSession.createDataFrame([], SCHEMA).schema)


def _open(condition: str, config: FeatureConfig) -> Column:
    """Whether a day is in the window of a condition, which its name ends with."""
    windows = {"week": config.week_days, "fortnight": config.fortnight_days, "month": config.month_days, "quarter": config.quarter_days}
    days = windows.get(condition.rpartition("_")[2])
    return F.lit(True) if days is None else F.coalesce(F.col("day") >= F.date_sub(as_of(config), days), F.lit(False))


def _measures(days: DataFrame, config: FeatureConfig, wanted: set[str]) -> DataFrame:
    """One row per customer with the wanted measures."""
    known: dict[str, Column] = {
        "purchases": F.sum("purchases"),
        "single_item_purchases": F.sum("single_item_purchases"),
        "mean_items": F.try_divide(F.sum("items").cast("double"), F.sum("baskets")),
        "mean_amount": F.try_divide(F.sum("amount"), F.sum("amount_rows"))
        if config.basket_grain == "item"
        else F.try_divide(F.sum("amount_means"), F.sum("means")),
        "last_purchase": F.max("last_purchase"),
    }
    for i, name in enumerate(item_conditions(config)):
        within = _open(name, config)
        known[f"any_{name}"] = F.bool_or(within & (F.col("conditions").bitwiseAND(1 << i) != 0))
        known[f"purchases_{name}"] = F.sum(F.when(within, F.col("condition_purchases")[i]).otherwise(0))
    for column in _FINGERPRINTS:
        known[f"some_{column}"], known[f"several_{column}"] = several(column)
    counted = f"distinct_{_COUNTED}"
    missing = wanted - known.keys() - {counted}
    if missing:
        raise ValueError(f"days do not hold {', '.join(sorted(missing))}")
    found = days.groupBy("customer_id").agg(F.count(F.lit(1)).alias("days"), *[known[m].alias(m) for m in sorted(wanted - {counted})])
    if counted not in wanted:
        return found
    kinds = days.select("customer_id", F.explode("categories").alias("category")).distinct()
    return found.join(kinds.groupBy("customer_id").agg(F.count(F.lit(1)).alias(counted)), "customer_id", "left")


def flags_from_days(
    customers: DataFrame, days: DataFrame, config: FeatureConfig = FeatureConfig(), names: Iterable[str] | None = None
) -> DataFrame:
    """The flags that `features.flags_from_items` gives for all items that the days were made of."""
    measures, columns = asked(config, FLAG_NAMES if names is None else names)
    who = customers.select("customer_id", F.to_date("registration_date").alias("registration_date"), "is_loyalty_member")
    return who.join(_measures(days, config, measures), "customer_id", "left").select("customer_id", *columns)
