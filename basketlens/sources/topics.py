"""Message topics as streams of (topic, value)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

@dataclass(frozen=True)
class KafkaTopics:
    """Topics of a broker. Needs the Kafka source on the class path. A batch takes all that is there, unless it is
    held to a number of messages.

    With min_offsets_per_trigger a batch waits until so many messages are there, but no longer than max_wait: it is
    written when it is large enough or old enough.
    """

    servers: str
    max_offsets_per_trigger: int | None = None
    min_offsets_per_trigger: int | None = None
    max_wait: str = "5s"

    def stream(self, spark: SparkSession, topics: Sequence[str]) -> DataFrame:
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", self.servers)
            .option("subscribe", ",".join(topics))
            .option("startingOffsets", "earliest")
        )
        if self.max_offsets_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", self.max_offsets_per_trigger)
        if self.min_offsets_per_trigger:
            reader = reader.option("minOffsetsPerTrigger", self.min_offsets_per_trigger)
            reader = reader.option("maxTriggerDelay", self.max_wait)
        return reader.load().select("topic", F.col("value").cast("string").alias("value"))

    def publish(self, messages: DataFrame, topic: str) -> None:
        (
            messages.select("value")
            .write.format("kafka")
            .option("kafka.bootstrap.servers", self.servers)
            .option("topic", topic)
            .save()
        )


@dataclass(frozen=True)
class FileTopics:
    """Topics as folders of text files in shared storage, one message per line.

    A batch is held to a number of files or of bytes; files that are published hold at most rows_per_file messages, so
    with one file a batch that is also the size of a batch in messages. Messages repeat the names of their fields, so files
    are compressed; a reader takes a compressed file whole and spreads its messages (`streaming.ingest.spread`). Files cut by
    rows stay plain: they are small, and batches held to bytes count them as they are stored.
    """

    root: str
    max_files_per_trigger: int | None = None
    max_bytes_per_trigger: str | None = None
    rows_per_file: int | None = None

    def path(self, topic: str) -> str:
        return f"{self.root}/{topic}"

    def stream(self, spark: SparkSession, topics: Sequence[str]) -> DataFrame:
        def one(topic: str) -> DataFrame:
            reader = spark.readStream
            for name, most in (("maxFilesPerTrigger", self.max_files_per_trigger), ("maxBytesPerTrigger", self.max_bytes_per_trigger)):
                reader = reader.option(name, most) if most else reader
            return reader.text(self.path(topic)).select(F.lit(topic).alias("topic"), "value")

        return reduce(DataFrame.unionByName, [one(topic) for topic in topics])

    def publish(self, messages: DataFrame, topic: str) -> None:
        writer = messages.select("value").write.mode("append")
        if self.rows_per_file:
            writer = writer.option("maxRecordsPerFile", self.rows_per_file)
        else:
            writer = writer.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
        writer.text(self.path(topic))
