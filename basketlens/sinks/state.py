"""Tables that hold one current row per key, in hash buckets."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.files import Files
from basketlens.session import scratch_scope, staged


@dataclass(frozen=True)
class Manifest:
    """Which generation of each bucket is in force after commit `number`, and the last batch applied of each stream."""

    number: int = 0
    in_force: Mapping[int, int] = field(default_factory=dict)
    applied: Mapping[str, int] = field(default_factory=dict)


@dataclass(frozen=True)
class KeyedTable:
    """One row per key below `path`, written as ``generation=<commit>/bucket=<b>``.

    A load rewrites the buckets its keys fall into and no other, in a new generation; a small manifest then puts them in
    force. Until that is there readers see the table as it was, so a load that is lost half-way has no effect and
    may simply run again. A batch that is named is applied once, whatever is repeated. One writer at a time.

    merge turns old and new rows together into one row per key; buckets should be as many that one is a task's worth.
    """

    path: str
    schema: str
    keys: tuple[str, ...]
    merge: Callable[[DataFrame], DataFrame]
    buckets: int = 64

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in self.keys]), F.lit(self.buckets)).cast("int")

    def manifest(self, spark: SparkSession) -> Manifest:
        """The newest one; an empty one for a new table."""
        newest = max(Files(spark, self.path).matching(f"{self.path}/_manifests/*.json"), default=None)
        if newest is None:
            return Manifest()
        held = json.loads(spark.read.text(newest, wholetext=True).first()[0])
        if held["buckets"] != self.buckets:
            raise ValueError(f"{self.path} has {held['buckets']} buckets")
        return Manifest(held["number"], {int(b): g for b, g in held["in_force"].items()}, held["applied"])

    def _commit(self, spark: SparkSession, m: Manifest) -> None:
        text = json.dumps({"number": m.number, "buckets": self.buckets, "in_force": m.in_force, "applied": m.applied})
        Files(spark, self.path).write_text(f"{self.path}/_manifests/{m.number:012d}.json", text)

    def read(self, spark: SparkSession, buckets: Iterable[int] | None = None, at: Manifest | None = None) -> DataFrame:
        """The rows in force, of all buckets or of some; no older generation is looked at."""
        held = (at or self.manifest(spark)).in_force
        wanted = held if buckets is None else [b for b in buckets if b in held]
        paths = [f"{self.path}/generation={held[b]}/bucket={b}" for b in sorted(wanted)]
        reader = spark.read.schema(self.schema)
        return reader.parquet(*paths) if paths else spark.createDataFrame([], self.schema)

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The rows whose key is among keys; only the buckets of these are read."""
        wanted = keys.select(*[F.col(f"`{k}`") for k in self.keys]).distinct()
        found = wanted.select(self.bucket().alias("bucket")).distinct().collect()  # at most `buckets` numbers
        return self.read(keys.sparkSession, [r.bucket for r in found]).join(wanted, list(self.keys), "left_semi")

    def upsert(self, rows: DataFrame, applied: Mapping[str, int] | None = None) -> list[int]:
        """Merges rows into the table; returns the buckets that were rewritten.

        applied names the batches that rows hold, the last number of each stream; nothing happens if all are in the table.
        """
        spark = rows.sparkSession
        before = self.manifest(spark)
        if applied and all(before.applied.get(s, -1) >= n for s, n in applied.items()):
            return []
        columns = spark.createDataFrame([], self.schema).columns
        number = before.number + 1
        with scratch_scope(spark):
            new = staged(rows.select(*columns).withColumn("bucket", self.bucket()), "upsert")
            touched = sorted(r.bucket for r in new.select("bucket").distinct().collect())
            if touched:
                both = self.read(spark, touched, before).unionByName(new.drop("bucket"))
                merged = self.merge(both).select(*columns).withColumn("bucket", self.bucket())
                dealt = merged.hint("rebalance", F.col("bucket"))
                dealt.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/generation={number}")
        seen = {s: max(n, before.applied.get(s, -1)) for s, n in (applied or {}).items()}
        in_force = {**before.in_force, **dict.fromkeys(touched, number)}
        self._commit(spark, Manifest(number, in_force, {**before.applied, **seen}))
        return touched

    def vacuum(self, spark: SparkSession, keep: int = 2) -> list[str]:
        """Deletes what none of the newest `keep` manifests has in force, and older manifests; returns the folders."""
        files = Files(spark, self.path)
        manifests = sorted(files.matching(f"{self.path}/_manifests/*.json"))
        held, last = set(), self.manifest(spark).number
        for text in spark.read.text(manifests[-keep:], wholetext=True).collect() if manifests else ():
            held |= {(g, int(b)) for b, g in json.loads(text[0])["in_force"].items()}
        deleted = []
        for folder in files.matching(f"{self.path}/generation=*/bucket=*"):
            generation, bucket = (int(part.partition("=")[2]) for part in folder.split("/")[-2:])
            if (generation, bucket) not in held and generation <= last:
                files.delete(folder)
                deleted.append(folder)
        for manifest in manifests[:-keep]:
            files.delete(manifest)
        return deleted
