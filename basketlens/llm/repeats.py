"""Passages that occur more than once in a corpus, found by seed and extend.

Every run of `words` words holds a winnowed anchor, at the same place wherever the run occurs. Documents are joined on
anchors; from a shared anchor a match is extended to the words on both sides. Nothing is done by pairs of documents: an
anchor whose surroundings are the same everywhere is settled at once, and otherwise each run of words around it is looked
up among those around the same anchor elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.llm.shared import ship, whole_text
from basketlens.session import staged

#: Words that a match has at least, and those of an anchor.
WORDS, ANCHOR = 35, 8
#: Bytes of text that are hashed at once, unless one text is longer.
AT_ONCE = 4_000_000

_SEED = 42
#: Odd, so that powers can be divided out modulo 2 ** 64; hashes of words are random numbers that they weigh.
_BASE = 0x9E3779B97F4A7C15


def split(text: bytes) -> list[bytes]:
    """Words between the six ASCII white-space characters."""
    return text.split()


def _mixed(x: np.ndarray) -> np.ndarray:
    """Each 64-bit number mapped to another one, so that all bits depend on all."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Hashes:
    """Hashes of runs of words, laid end to end over several texts."""

    def __init__(self, texts: list[bytes]):
        import xxhash

        digest = xxhash.xxh64_intdigest
        each = [split(t) for t in texts]
        self.bounds = np.cumsum([0, *map(len, each)])
        words = np.array([digest(w, _SEED) for ws in each for w in ws], np.uint64)
        n = len(words)
        self.powers = np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(n, _BASE, np.uint64))))
        self.inverses = np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(n, pow(_BASE, -1, 1 << 64), np.uint64))))
        # two sums of words weighed by place: one for anchors, one of other numbers for what surrounds them
        self.sums = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(x * self.powers[:n]))) for x in (words, _mixed(words))]

    def of(self, which: int, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the words from begin up to end."""
        sums = self.sums[which]
        return _mixed((sums[end] - sums[begin]) * self.inverses[begin] + (end - begin).astype(np.uint64))


def anchors(hashes: Hashes, words: int = WORDS, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """Winnowing: of the anchors in each window of `words` words the one with the least hash is its own, the last of equal
    ones. Windows that follow each other and have the same one make one row: first window, number of windows, place of the
    anchor, hash of the anchor, hash of all words of these windows with the anchor's place in them. Places count all
    texts' words."""
    n = int(hashes.bounds[-1])
    starts = np.concatenate([np.zeros(0, np.int64), *[np.arange(a, b - words + 1) for a, b in zip(hashes.bounds[:-1], hashes.bounds[1:]) if b - a >= words]])
    if not len(starts):
        return (*(np.zeros(0, np.int64),) * 3, *(np.zeros(0, np.uint64),) * 2)
    places = np.arange(n - anchor + 1)
    value = hashes.of(0, places, places + anchor)
    best, width, wanted = places, 1, words - anchor + 1
    while width < wanted:
        step = min(width, wanted - width)
        left, right = best[: len(best) - step], best[step:]
        best = np.where(value[right] <= value[left], right, left)
        width += step
    own = best[starts]
    cuts = np.concatenate(([True], (np.diff(own) != 0) | (np.diff(starts) != 1)))
    at = np.flatnonzero(cuts)
    first, number, place = starts[at], np.diff(at, append=len(starts)), own[at]
    around = _mixed(hashes.of(1, first, first + number + words - 1) ^ ((place - first) << 32).astype(np.uint64))
    return first, number, place, value[place], around


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def _texts(column: pa.Array) -> list[bytes]:
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [t.as_buffer().to_pybytes() for t in column.cast(kind)]


def _portions(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of texts that are taken together."""
    begin = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > AT_ONCE:
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)


_KEY = ("key_a", "key_b")


def _keyed(docs: DataFrame) -> DataFrame:
    """key_a, key_b, text and doc_id. The key names a row by 128 bits of id and text: rows alike in both have the same repeats."""
    text = whole_text()
    return docs.select(F.xxhash64("doc_id", text).alias("key_a"), F.xxhash64(text, F.lit(1), "doc_id").alias("key_b"), text.alias("text"), "doc_id")


def _seeds(keyed: DataFrame, words: int, anchor: int) -> DataFrame:
    """key_a, key_b, seed, around, first (window) and number (of windows) for each anchor of every text."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _texts(batch.column(2))
            keys = [batch.column(k).to_numpy() for k in range(2)]
            for a, b in _portions(list(map(len, texts))):
                hashes = Hashes(texts[a:b])
                first, number, _, seed, around = anchors(hashes, words, anchor)
                row = np.searchsorted(hashes.bounds, first, "right") - 1
                own = [pa.array(k[a:b][row]) for k in keys]
                counts = [pa.array((first - hashes.bounds[row]).astype(np.int32)), pa.array(number.astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*own, _longs(seed), _longs(around), *counts], names=[*_KEY, "seed", "around", "first", "number"])

    return keyed.select(*_KEY, "text").mapInArrow(task, "key_a long, key_b long, seed long, around long, first int, number int")


def _packed(keyed: DataFrame, *keep: str) -> DataFrame:
    """The key, the texts as zstd frames, which shuffle at half the size, and the `keep` columns."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        tool = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            frames = pa.array([tool.compress(t) for t in _texts(batch.column(2))], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], frames, *batch.columns[3:]], names=schema.names)

    key = T.StructType.fromDDL("key_a long, key_b long, frame binary")
    schema = T.StructType([*key.fields, *keyed.select(*keep).schema.fields])
    return keyed.select(*_KEY, "text", *keep).mapInArrow(task, schema)


def _opened(frames: pa.Array) -> list[bytes]:
    import zstandard

    tool = zstandard.ZstdDecompressor()
    return [tool.decompress(f.as_py()) for f in frames]


def _extended(texts: DataFrame, words: int, anchor: int) -> DataFrame:
    """key_a, key_b, seed, window (a hash) and first of each window around the anchors in `unsettled` (their first windows)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, wanted = [batch.column(k).to_numpy() for k in range(2)], batch.column(3)
            frames = batch.column(2)
            for a, b in _portions([3 * len(f.as_buffer()) for f in frames]):
                hashes = Hashes(_opened(frames[a:b]))
                first, number, _, seed, _ = anchors(hashes, words, anchor)
                at = np.concatenate([np.zeros(0, np.int64), *[w.values.to_numpy() + hashes.bounds[i] for i, w in enumerate(wanted[a:b])]])
                picked = np.isin(first, at)
                number, seed = number[picked], seed[picked]
                begin = np.repeat(first[picked] - np.cumsum(number) + number, number) + np.arange(number.sum())
                row = np.searchsorted(hashes.bounds, begin, "right") - 1
                windows = hashes.of(1, begin, begin + words)
                own = [pa.array(k[a:b][row]) for k in keys]
                places = pa.array((begin - hashes.bounds[row]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([*own, _longs(np.repeat(seed, number)), _longs(windows), places], names=[*_KEY, "seed", "window", "first"])

    return texts.mapInArrow(task, "key_a long, key_b long, seed long, window long, first int")


def _spans(places: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of intervals as ascending disjoint ones that don't touch."""
    order = np.argsort(places, kind="stable")
    places, reach = places[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(places), bool)
    new[1:] = places[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return places[at], reach[np.append(at[1:], len(places)) - 1] if len(places) else reach


def covered(docs: DataFrame, words: int = WORDS, anchor: int = ANCHOR) -> DataFrame:
    """key_a, key_b and, in `runs`, where runs of repeated windows begin and how many windows they have (two numbers in one
    long), for each different row of docs that has some."""
    ship(docs.sparkSession)
    texts = _keyed(docs)
    seeds = _seeds(texts, words, anchor)
    # map tasks combine: a hot anchor comes from each of them as one row
    met = seeds.groupBy("seed").agg(F.count(F.lit(1)).alias("n"), (F.min("around") == F.max("around")).alias("settled"))
    shared = staged(met.where("n > 1").select("seed", "settled"), "shared")
    packed = F.shiftleft(F.col("first").cast("long"), 32).bitwiseOR(F.col("number").cast("long"))
    hits = seeds.select(*_KEY, "seed", packed.alias("run")).join(shared, "seed")
    by_row = staged(
        hits.groupBy(*_KEY).agg(
            F.collect_set(F.when(F.col("settled"), F.col("run"))).alias("settled"),
            F.collect_set(F.when(~F.col("settled"), F.shiftright("run", 32).cast("int"))).alias("unsettled"),
        ),
        "anchored",
    )
    open_ones = by_row.where(F.size("unsettled") > 0).select(*_KEY, "unsettled")
    around = staged(_extended(_packed(texts).join(open_ones, [*_KEY]).select(*_KEY, "frame", "unsettled"), words, anchor), "windows")
    twice = around.groupBy("seed", "window").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("seed", "window")
    one = F.shiftleft(F.col("first").cast("long"), 32).bitwiseOR(F.lit(1).cast("long"))
    extended = around.join(staged(twice, "twice"), ["seed", "window"]).groupBy(*_KEY).agg(F.collect_set(one).alias("single"))
    both = by_row.select(*_KEY, "settled").join(extended, [*_KEY], "left")
    found = both.select(*_KEY, F.concat("settled", F.coalesce("single", F.array().cast("array<bigint>"))).alias("runs"))
    return staged(found.where(F.size("runs") > 0), "covered")


def _ranges(runs: pa.Scalar, words: int) -> tuple[np.ndarray, np.ndarray]:
    values = runs.values.to_numpy() if runs.is_valid else np.zeros(0, np.int64)
    first = values >> 32
    return _spans(first, first + (values & 0xFFFFFFFF) + words - 1)


def repeats(docs: DataFrame, words: int = WORDS, anchor: int = ANCHOR) -> DataFrame:
    """For each row of docs its repeated passages and what is left without them.

    doc_id, n_words, begins and ends (arrays of long, in words: the longest ranges of which every word lies in `words`
    consecutive words that start somewhere else too, in this or another document), n_removed (words in them) and kept (the
    other words, joined by spaces). What counts as repeated is judged on docs as given.

    A null text is an empty one; texts of fewer than `words` words have no passages; rows alike are copies of each other, so
    all their words go if they have enough; a null doc_id is kept; an empty table gives no row. Other columns are not looked
    at. A text is hashed by one task; everything else is spread over anchors and windows.
    """
    found = covered(docs, words, anchor)
    joined = _packed(_keyed(docs), "doc_id").join(found, [*_KEY], "left").select("doc_id", "frame", "runs")
    columns = T.StructType.fromDDL("n_words long, begins array<long>, ends array<long>, n_removed long, kept string")
    schema = T.StructType([docs.select("doc_id").schema[0], *columns.fields])
    kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in _portions([3 * len(f.as_buffer()) for f in batch.column(1)]):
                rows: list[list] = [[] for _ in range(5)]
                for text, runs in zip(_opened(batch.column(1)[a:b]), batch.column(2)[a:b]):
                    own = split(text)
                    begins, ends = _ranges(runs, words)
                    kept, at = [], 0
                    for begin, end in zip(begins.tolist(), ends.tolist()):
                        kept += own[at:begin]
                        at = end
                    kept += own[at:]
                    for column, value in zip(rows, (len(own), begins, ends, len(own) - len(kept), b" ".join(kept))):
                        column.append(value)
                arrays = [pa.array(c, k) for c, k in zip(rows, kinds)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], *arrays, pa.array(rows[4], pa.binary()).cast(pa.string())], names=schema.names)

    return joined.mapInArrow(task, schema)


def without_repeats(docs: DataFrame, words: int = WORDS, anchor: int = ANCHOR) -> DataFrame:
    """doc_id, n_words, n_removed and the digest of the words that stay; see `repeats`."""
    found = repeats(docs, words, anchor)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
