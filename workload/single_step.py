"""The customer flags by plain distinct counts over the wide fact.

The straightforward form, kept to compare results and time with the library's staged aggregation: Spark
copies every item once per distinct expression here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.config import FeatureConfig
from basketlens.operators.features import FLAGS, Profile, item_conditions


def single_step_flags(fact: DataFrame, config: FeatureConfig) -> DataFrame:
    profile = Profile(config)
    flags = [F.coalesce(f.rule(profile, config), F.lit(False)).alias(f.name) for f in FLAGS]
    conditions = item_conditions(config)
    measures = [
        F.max("registration_date").alias("registration_date"),
        F.max("is_loyalty_member").alias("is_loyalty_member"),
        F.count_distinct("purchase_id").alias("purchases"),
        F.max("purchase_datetime").alias("last_purchase"),
        F.avg("total_amount").alias("mean_amount"),
    ]
    measures += [F.count_distinct(c).alias(f"distinct_{c}") for c in profile.breadths]
    for c in profile.fingerprints:
        measures.append((F.count_distinct(c) > 0).alias(f"some_{c}"))
        measures.append((F.count_distinct(c) > 1).alias(f"several_{c}"))
    for name in profile.conditions:
        measures.append(F.max(conditions[name]).alias(f"any_{name}"))
        if f"purchases_{name}" in profile.measures:
            measures.append(F.count_distinct(F.when(conditions[name], F.col("purchase_id"))).alias(f"purchases_{name}"))
    baskets = (
        fact.groupBy("customer_id", "purchase_id")
        .agg(F.count("product_id").alias("items"))
        .groupBy("customer_id")
        .agg(F.count_if(F.col("items") == 1).alias("single_item_purchases"), F.avg("items").alias("mean_items"))
    )
    return fact.groupBy("customer_id").agg(*measures).join(baskets, "customer_id", "left").select("customer_id", *flags)
