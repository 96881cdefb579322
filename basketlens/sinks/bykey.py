"""Tables stored by the hash of one key, so that they are joined on it without a shuffle."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.files import Files


@dataclass(frozen=True)
class TableByKey:
    """Rows below `path`: ``usual`` in buckets of the key's hash, each sorted by the key, and ``often`` as they come.

    Two such tables with the same buckets are joined bucket by bucket. A bucket is one task, so keys that would make one
    too large do not go there: a key with more rows than an even bucket would have is frequent, and there are at most as
    many frequent keys as buckets, whatever the data are. They are listed in ``keys``, their rows stand in ``often``
    with the rows that have no key. Buckets should be as many that one is a task's worth. A table of `unique` keys has
    no frequent ones, and none are looked for.
    """

    path: str
    key: str
    buckets: int = 64
    unique: bool = False

    def write(self, df: DataFrame) -> None:
        """Replaces the table. Its layout is put down last, so a table whose write was lost can't be read."""
        spark = df.sparkSession
        Files(spark, self.path).delete(self.path)
        key = F.col(f"`{self.key}`")
        rows = df.where(key.isNotNull())
        if self.unique:
            frequent = spark.createDataFrame([], T.StructType([T.StructField(self.key, df.schema[self.key].dataType)]))
        else:
            limit = rows.count() / self.buckets
            frequent = rows.groupBy(key.alias(self.key)).count().where(F.col("count") > limit).select(self.key)
        frequent.coalesce(1).write.parquet(f"{self.path}/keys")
        known = F.broadcast(spark.read.schema(frequent.schema).parquet(f"{self.path}/keys"))
        often = df.join(known, self.key, "left_semi").unionByName(df.where(key.isNull()))
        often.write.parquet(f"{self.path}/often")
        usual = rows.join(known, self.key, "left_anti").repartition(self.buckets, key)
        name = _unused()
        writer = usual.write.bucketBy(self.buckets, self.key).sortBy(self.key).format("parquet")
        writer.option("path", f"{self.path}/usual").saveAsTable(name)
        spark.sql(f"DROP TABLE {name}")  # its files stay, the table is not the catalogue's
        layout = {"buckets": self.buckets, "key": self.key, "schema": df.schema.jsonValue()}
        Files(spark, self.path).write_text(f"{self.path}/layout.json", json.dumps(layout))

    def _schema(self, spark: SparkSession) -> T.StructType:
        held = json.loads(spark.read.text(f"{self.path}/layout.json", wholetext=True).first()[0])
        if (held["buckets"], held["key"]) != (self.buckets, self.key):
            raise ValueError(f"{self.path} has {held['buckets']} buckets of {held['key']}")
        return T.StructType.fromJson(held["schema"])

    def usual(self, spark: SparkSession) -> DataFrame:
        """The rows in buckets."""
        name = _unused()
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self._schema(spark).fields)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) "
            f"INTO {self.buckets} BUCKETS LOCATION '{self.path}/usual'"
        )
        try:
            return spark.table(name)
        finally:
            spark.sql(f"DROP TABLE {name}")

    def often(self, spark: SparkSession) -> DataFrame:
        """The rows of frequent keys, and those without a key."""
        return spark.read.schema(self._schema(spark)).parquet(f"{self.path}/often")

    def frequent(self, spark: SparkSession) -> DataFrame:
        """The frequent keys: at most as many rows as there are buckets."""
        kind = self._schema(spark)[self.key].dataType
        return spark.read.schema(T.StructType([T.StructField(self.key, kind)])).parquet(f"{self.path}/keys")

    def read(self, spark: SparkSession) -> DataFrame:
        """All rows."""
        return self.usual(spark).unionByName(self.often(spark))


def _unused() -> str:
    return f"basketlens_{uuid.uuid4().hex}"
