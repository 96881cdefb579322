"""One daily run. When to run it is up to the scheduler of the deployment."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from basketlens import schemas
from basketlens.config import FeatureConfig, MaskingConfig
from basketlens.plans.publish import publish
from basketlens.plans.report import publish_report
from basketlens.session import prepare
from basketlens.sinks.retention import expire, rewrite_boundary
from basketlens.streaming.ingest import Lake, ingest


def run(
    spark: SparkSession,
    collections: Mapping[str, DataFrame],
    topics,
    lake: Lake,
    target: str,
    masking: MaskingConfig,
    features: FeatureConfig = FeatureConfig(),
    loaded_at: dt.datetime | None = None,
    retention_months: int | None = 12,
) -> str:
    """Publish the collections, drain the topics into the tables, write the report; returns its folder.

    RAW rows that are `retention_months` old are deleted after that (None: nothing is): whole months, and of the oldest
    month that stays the rows that have expired.
    """
    prepare(spark)
    loaded_at = loaded_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    publish(collections, topics, masking, loaded_at)
    ingest(spark, topics, lake)
    path = publish_report(spark, lake, target, features)
    if retention_months is not None:
        for entity in schemas.ENTITIES:
            raw = lake.raw(entity)
            expire(spark, raw, loaded_at.date(), retention_months, above=2)
            rewrite_boundary(spark, raw, loaded_at.date(), retention_months, above=2)
    return path
