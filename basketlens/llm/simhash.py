"""SimHash near-duplicates by a positional byte index with count filtering."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.llm.shared import fresh, ship, whole_text
from basketlens.session import staged

#: Fingerprints link at this many differing bits or fewer.
BITS = 4
#: At most BITS of the 8 bytes differ, so linked fingerprints share at least so many bytes in place.
SHARED = 8 - BITS
#: Fingerprints with one key that are compared directly; more are dealt out again by half-bytes.
TOGETHER = 4096

_PLACES = list(combinations(range(8), SHARED))
_SEED = 42


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


#: For each choice of positions: the mask of those bytes.
_BYTE_MASKS = [sum(0xFF << 8 * i for i in places) for places in _PLACES]


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """SimHash of a text in UTF-8: A-Z lower-cased, XXH64 (seed 42) of each run of `shingle` words, repeats included.

    A text with fewer words has one shingle, all its words; one without words has fingerprint 0.
    """
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    joined, sizes = b" ".join(words), np.array([len(w) for w in words])
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    ends = ends[shingle - 1 :] if len(words) > shingle else ends[-1:]
    digest, ones, count = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(ends)
    for i in range(0, count, 1 << 16):
        begin, end = starts[: count][i : i + (1 << 16)].tolist(), ends[i : i + (1 << 16)].tolist()
        hashes = np.array([digest(joined[a:b], _SEED) for a, b in zip(begin, end)], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<u8")[0])


def signatures(docs: DataFrame, *keep: str, column: str = "text", shingle: int = 4) -> DataFrame:
    """The `keep` columns of every row and the fingerprint (a signed 64-bit number) of its whole text."""
    ship(docs.sparkSession)
    text, name = fresh(docs.select(*keep), "text", "fingerprint")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(keep)).cast(pa.large_binary() if pa.types.is_large_string(batch.column(len(keep)).type) else pa.binary())
            values = np.array([fingerprint(t.as_buffer().to_pybytes(), shingle) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(values.view(np.int64))], names=[*keep, name])

    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField(name, T.LongType())])
    rows = docs.select(*keep, whole_text(column).alias(text)).mapInArrow(task, schema)
    return rows.withColumnRenamed(name, "fingerprint")


def _canonical() -> np.ndarray:
    """For each set of shared byte positions: which choice holds its first ones, -1 if it has too few."""
    numbers = {places: i for i, places in enumerate(_PLACES)}
    found = [[i for i in range(8) if mask >> i & 1] for mask in range(256)]
    return np.array([numbers[tuple(x[:SHARED])] if len(x) >= SHARED else -1 for x in found])


def links(nodes: DataFrame) -> DataFrame:
    """Links (a, b) that join different fingerprints just as all pairs at BITS or fewer differing bits do.

    nodes: different fingerprints. Each one stands in the index under every choice of SHARED positional
    bytes. Under one key the shared bytes of each pair are tallied; a pair that reaches SHARED of them is
    looked at only under the first choice that holds, and kept if its bits verify. Of what is kept, a key
    gives a spanning forest. A key with more than TOGETHER fingerprints is split by SHARED of the
    8 half-bytes outside its bytes, after which at most 65,536 different fingerprints can agree.
    """
    ship(nodes.sparkSession)
    keyed = _indexed(nodes.select("fingerprint", F.lit(None).cast("int").alias("choice")), list(enumerate(_BYTE_MASKS)))
    first = staged(keyed.mapInArrow(_linker(TOGETHER), "a long, b long, choice int"), "links")
    found = first.where("b is not null").select("a", "b")
    hot = first.where("b is null")
    if hot.isEmpty():
        return found
    parts = [
        (choice, _BYTE_MASKS[choice] | sum(0xF << h for h in halves))
        for choice in range(len(_PLACES))
        for halves in combinations([8 * i + k for i in range(8) if i not in _PLACES[choice] for k in (0, 4)], SHARED)
    ]
    again = _indexed(hot.select(F.col("a").alias("fingerprint"), "choice"), parts)
    return found.union(again.mapInArrow(_linker(None), "a long, b long, choice int").select("a", "b"))


def _indexed(rows: DataFrame, masks: list[tuple[int, int]]) -> DataFrame:
    """Rows under each of the masks, those with one key next to each other; a row with a choice only under the masks of it."""
    by_choice: dict[int, list[Column]] = {}
    for choice, mask in masks:
        by_choice.setdefault(choice, []).append(F.struct(F.lit(choice).alias("choice"), F.lit(_signed(mask)).alias("mask")))
    every = F.array(*[m for group in by_choice.values() for m in group])
    chosen = every if len(by_choice) == len(masks) else F.filter(every, lambda m: m["choice"] == F.col("choice"))
    spread = rows.select("fingerprint", F.explode(chosen).alias("m"))
    keyed = spread.select(
        F.col("m.choice").alias("choice"),
        F.col("m.mask").alias("mask"),
        F.col("fingerprint").bitwiseAND(F.col("m.mask")).alias("key"),
        "fingerprint",
    )
    # choices differ in what they look at, even where their masks are the same
    return keyed.repartition("choice", "mask", "key").sortWithinPartitions("choice", "mask", "key", "fingerprint")


def _linker(most: int | None):
    canonical = _canonical()

    def forest(values: np.ndarray, choice: int) -> tuple[list[int], list[int]]:
        left, a, b = values, [], []
        while len(left) > 1:
            root, left = left[0], left[1:]
            queue = [root]
            while queue and len(left):
                differ = left ^ queue.pop()
                agree = np.packbits(differ.view(np.uint8).reshape(-1, 8) == 0, axis=1, bitorder="little")[:, 0]
                near = (canonical[agree] == choice) & (np.bitwise_count(differ) <= BITS)
                if near.any():
                    reached = left[near]
                    queue.extend(reached)
                    a.extend([int(root.view(np.int64))] * len(reached))
                    b.extend(reached.view(np.int64).tolist())
                    left = left[~near]
        return a, b

    def rows(a: list, b: list, choice: list) -> pa.RecordBatch:
        return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(choice, pa.int32())], names=["a", "b", "choice"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, hot = None, [], False

        def close() -> Iterator[pa.RecordBatch]:
            if not hot and sum(map(len, held)) > 1:
                a, b = forest(np.concatenate(held), current[2])
                if a:
                    yield rows(a, b, [current[2]] * len(a))

        for batch in batches:
            choice, mask, key, value = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            value = value.astype("<i8").view(np.uint64)
            if not len(value):
                continue
            cuts = np.flatnonzero((choice[1:] != choice[:-1]) | (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1
            starts = np.concatenate(([0], cuts))
            ends = np.concatenate((cuts, [len(value)]))
            # of the runs inside the batch only those of two and more can hold a link
            open_runs = (ends - starts > 1) | (starts == 0) | (ends == len(value))
            for begin, end in zip(starts[open_runs].tolist(), ends[open_runs].tolist()):
                own = (mask[begin], key[begin], int(choice[begin]))
                if own != current:
                    yield from close()
                    current, held, hot = own, [], False
                held.append(value[begin:end])
                if most is not None and (hot or sum(map(len, held)) > most):
                    hot = True
                    for part in held:
                        yield rows(part.view(np.int64), [None] * len(part), [own[2]] * len(part))
                    held = []
        yield from close()

    return task


def components(edges: DataFrame) -> DataFrame:
    """For each end of an edge (a, b) its component: node, root (the same for all that can be reached).

    Each round points every node at its least neighbour if that is smaller, follows the pointers some steps and
    contracts the edges. Each round's tables are written to the shared scratch folder.
    """
    edges = staged(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    labels = None
    while labels is None or not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        parent = staged(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("parent")), "parents")
        for _ in range(3):
            up = parent.select(F.col("node").alias("parent"), F.col("parent").alias("up"))
            parent = parent.join(up, "parent").select("node", F.col("up").alias("parent"))
        parent = staged(parent, "parents")
        if labels is None:
            labels = parent.select("node", F.col("parent").alias("root"))
        else:
            moved = parent.select(F.col("node").alias("root"), "parent")
            labels = labels.join(moved, "root", "left").select("node", F.coalesce("parent", "root").alias("root"))
            labels = staged(labels, "labels")
        ends = [parent.select(F.col("node").alias(c), F.col("parent").alias(f"{c}_root")) for c in ("a", "b")]
        moved = edges.join(ends[0], "a").join(ends[1], "b").where("a_root <> b_root")
        edges = staged(moved.select(F.least("a_root", "b_root").alias("a"), F.greatest("a_root", "b_root").alias("b")).distinct(), "edges")
    return labels


def grouped(rows: DataFrame, first: Column) -> DataFrame:
    """For each different fingerprint of rows, the least `first` of all rows reachable from it: fingerprint, first."""
    nodes = staged(rows.groupBy("fingerprint").agg(F.min(first).alias("first")), "fingerprints")
    roots = components(links(nodes.select("fingerprint"))).withColumnRenamed("node", "fingerprint")
    member = staged(nodes.join(roots, "fingerprint", "left").select("fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")), "members")
    least = member.groupBy("root").agg(F.min("first").alias("first"))
    return staged(member.select("fingerprint", "root").join(least, "root").select("fingerprint", "first"), "groups")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (the least doc_id that links reach) of every row.

    A null text is an empty one; all texts without words link, as fingerprint 0 does to any other. A null doc_id
    takes part in linking; a component has a null id only if none of its rows has one. An empty table gives no row.
    """
    rows = staged(signatures(docs, "doc_id"), "signatures")
    groups = grouped(rows, F.col("doc_id")).withColumnRenamed("first", "component_id")
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return rows.join(groups, "fingerprint").select("doc_id", digits.alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of docs, all columns, with one of each component: that with the least doc_id (nulls last), of those
    with one doc_id the one whose text has the least hash. Rows alike in both are one."""
    hash_, none, key, order = fresh(docs, "text_hash", "no_id", "id", "order")
    # the key of the join is that of the window too, so the texts are shuffled once
    named = docs.withColumns({hash_: F.xxhash64(whole_text()), none: F.col("doc_id").isNull(), key: F.coalesce("doc_id", F.lit(0))})
    rows = staged(signatures(named, none, key, hash_), "signatures")
    best = F.struct(*[F.col(c).alias(c) for c in (none, key, hash_)])
    kept = staged(grouped(rows, best).select("first.*").distinct(), "kept")
    found = named.join(kept, [none, key, hash_], "left_semi")
    one = Window.partitionBy(none, key, hash_).orderBy(F.lit(0))
    return found.withColumn(order, F.row_number().over(one)).where(F.col(order) == 1).select(*[f"`{c}`" for c in docs.columns])
