"""Topic -> RAW -> MART as one streaming query per entity.

Each query has its own checkpoint, so the offsets of an entity are committed only after its own rows
are written; with per-batch folders a replayed batch overwrites itself. Nothing else is kept between
batches, hence no state store and no watermark.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from basketlens import schemas
from basketlens.operators import marts
from basketlens.operators.dedup import latest_by_key
from basketlens.operators.flatten import json_to_raw
from basketlens.session import shuffles_dropped
from basketlens.sinks.state import KeyedTable
from basketlens.sinks.tables import by_month, load_month, write_batch, write_routed
from basketlens.sources.tables import batch_folders

#: Fixed value: a batch is at most this old before it is written.
MAX_WAIT = "5 seconds"
#: Fixed value: bytes of a row group of RAW files. The views read them at once, on all cores although files are few.
ROW_GROUP = 16 << 20


@dataclass(frozen=True)
class Lake:
    """Folder layout of the tables below one root in shared storage."""

    root: str

    def raw(self, entity: str) -> str:
        return f"{self.root}/mart_raw/{entity}"

    @property
    def marts(self) -> str:
        """All marts, and what their views refuse."""
        return f"{self.root}/mart"

    def mart(self, name: str) -> str:
        return f"{self.marts}/mart={name}"

    def unreadable(self, entity: str) -> str:
        return f"{self.root}/quarantine/messages/{entity}"

    def rejected(self, view: str) -> str:
        return f"{self.mart(marts.REJECTED)}/view={view}"

    def current(self, name: str) -> KeyedTable:
        """A mart as one row per key, the newest."""
        keys = schemas.MART_KEYS[name]
        return KeyedTable(f"{self.root}/current/{name}", schemas.MART[name], keys, lambda df: latest_by_key(df, keys))

    def checkpoint(self, entity: str) -> str:
        return f"{self.root}/checkpoints/{entity}"


def parse(messages: DataFrame) -> DataFrame:
    """Message text with the JSON object in it as a variant; text that holds none is marked, not dropped.

    The text is parsed below a generator of one row, as a filter by what is readable is not moved below that: it would parse
    the text a second time.
    """
    document = F.explode(F.array(F.try_parse_json("value")))
    is_object = F.col("value").rlike(r"\A\s*\{")
    return messages.select("value", document.alias("document")).withColumn(
        "readable", F.coalesce(F.col("document").isNotNull() & is_object, F.lit(False))
    )


def spread(batch: DataFrame) -> DataFrame:
    """The messages of a batch over all cores: a compressed file is read by one task, which would parse all of it.

    They are dealt out by their place in it, so no hot text and no sort.
    """
    cores = batch.sparkSession.sparkContext.defaultParallelism
    placed = batch.select("value", F.monotonically_increasing_id().alias("place"))
    return placed.repartition(cores, "place").select("value")


def fill_marts(raw: DataFrame, entity: str, lake: Lake, batch_id: int, keep_rejects: bool = True) -> None:
    """Run every view fed by the entity on one batch of RAW rows: one scan, one job, one write."""
    rows = marts.routed(raw, marts.views_of(entity), keep_rejects)
    write_routed(rows.withColumn("load_month", load_month()), lake.marts, batch_id, "mart", "view", "load_month")


def current_addresses(spark: SparkSession, lake: Lake) -> KeyedTable:
    """The newest address per key, brought up to date with the batches written since it was used last."""
    table = lake.current("address")
    folders, last = batch_folders(spark, lake.mart("address"), table.manifest(spark).applied)
    if folders:
        table.upsert(spark.read.schema(schemas.MART["address"]).parquet(*folders), last)
        table.vacuum(spark)
    return table


def ingest_batch(entity: str, lake: Lake, keep_rejects: bool = True) -> Callable[[DataFrame, int], None]:
    """The per-batch step: RAW rows first, then the views on what was written.

    The views read the columnar RAW files of the batch, each only the columns it needs, rather than
    parsing the messages again. Messages are kept nowhere in between; they are parsed again only for the unreadable ones of
    a batch of which fewer rows than messages have reached RAW.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        parsed = parse(spread(batch))
        raw = json_to_raw(parsed.filter("readable"), entity)
        path = write_batch(by_month(raw, schemas.RAW_ORDER[entity]), lake.raw(entity), batch_id, "load_month", row_group=ROW_GROUP)
        written = spark.read.schema(raw.schema).parquet(path)
        missing = "NOT readable" if batch.count() > written.count() else F.lit(False)
        write_batch(parsed.filter(missing).select("value"), lake.unreadable(entity), batch_id)
        fill_marts(written, entity, lake, batch_id, keep_rejects)

    return step


def start(
    messages: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, name: str, drain: bool = True
) -> StreamingQuery:
    """Start a query; ``drain`` stops it once everything present has been written."""
    trigger = {"availableNow": True} if drain else {"processingTime": MAX_WAIT}
    return (
        messages.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .foreachBatch(step)
        .start()
    )


def ingest(
    spark: SparkSession, topics, lake: Lake, entities: Sequence[str] = schemas.ENTITIES, drain: bool = True
) -> list[StreamingQuery]:
    """Start the queries of all entities; with ``drain`` wait for them and raise what they raised."""
    with shuffles_dropped(spark):  # a stream keeps the settings it is started with
        running = [
            start(topics.stream(spark, [e]), ingest_batch(e, lake), lake.checkpoint(e), f"ingest_{e}", drain)
            for e in entities
        ]
    if drain:
        try:
            for query in running:
                query.awaitTermination()
        finally:
            for query in running:  # none goes on alone after another one has failed
                query.stop()
    return running


def append_batches(table: str, *partition_by: str) -> Callable[[DataFrame, int], None]:
    """Per-batch step that only stores the rows, for streams without a mart behind them."""

    def step(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, table, batch_id, *partition_by)

    return step


def route(table: str, topic_column: str = "topic") -> Callable[[DataFrame, int], None]:
    """Per-batch step that sends every row to the folder of its topic in a single pass."""
    return append_batches(table, topic_column)
