"""Stupid-backoff scores from n-gram count tables partitioned by hash.

The relation of exploded n-grams is kept in packets: one row holds all different n-gram hashes that a block of
documents sends to one hash range. A packet is answered with the counts its hashes have in the other blocks, in order.
Longer n-grams go in later rounds: one is sent only if both shorter n-grams in it occur in other blocks, since it
cannot occur there otherwise. Blocks that share an n-gram share these too, so all of them send it.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.llm.shared import ship, whole_text
from basketlens.session import scratch_path, staged

ORDER, BACKOFF = 3, 0.4
#: Characters of a block of documents (one document may be longer), and n-grams of a hash range.
BLOCK_CHARS, RANGE_GRAMS = 8_000_000, 4_000_000


def _pack(values: np.ndarray) -> bytes:
    """Numbers with bytes of one place next to each other, compressed."""
    import zstandard

    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(data: bytes, kind: type) -> np.ndarray:
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, len(raw) // size).T).reshape(-1).view(kind)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The 64-bit hash of a sequence from that of its beginning and of its last word."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Block:
    """The words of some documents as numbers, and the hashes of their n-grams."""

    def __init__(self, vocabulary: np.ndarray, words: np.ndarray, sizes: np.ndarray, order: int):
        self.document = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        hashes = vocabulary[words] if len(words) else np.zeros(0, np.uint64)
        #: by length: the n-gram that ends at each place (where `at` is true), as a number within the block
        self.at, found, current = [], [], hashes
        for n in range(order):
            if n:
                before = np.concatenate((np.zeros(1, np.uint64), current[:-1])) if len(current) else current
                current = _mix(before + np.uint64(n), hashes)
            self.at.append(place >= n)
            found.append(current[self.at[n]])
        self.grams, inverse = np.unique(np.concatenate(found), return_inverse=True)
        self.number = []
        for at in self.at:
            own = np.zeros(len(words), np.int64)
            own[at], inverse = inverse[: at.sum()], inverse[at.sum() :]
            self.number.append(own)

    def sent(self, round_: int, elsewhere: np.ndarray) -> np.ndarray:
        """The n-grams, ascending, of a round: first those of one and two words, then of one word more in each."""
        chosen = np.zeros(len(self.grams), bool)
        if not round_:
            for number, at in zip(self.number[:2], self.at[:2]):
                chosen[number[at]] = True
        elif len(self.grams):
            n = round_ + 1
            at, known = self.at[n], (elsewhere > 0)[self.number[n - 1]]
            chosen[self.number[n][at & known & np.roll(known, 1)]] = True
        return np.flatnonzero(chosen)

    def elsewhere(self, answers: pd.DataFrame) -> np.ndarray:
        """The counts in other blocks, as far as the answers to the rounds so far tell; zero for what was not sent."""
        found = np.zeros(len(self.grams), np.int64)
        for round_, packets in answers.sort_values(["round", "range"]).groupby("round"):
            found[self.sent(round_, found)] = np.concatenate([_unpack(t, np.int64) for t in packets["elsewhere"]])
        return found

    def counts(self) -> np.ndarray:
        both = [number[at] for number, at in zip(self.number, self.at)]
        return np.bincount(np.concatenate(both), minlength=len(self.grams))

    def scores(self, totals: np.ndarray, corpus_words: int, sizes: np.ndarray, backoff: float) -> np.ndarray:
        """The sum of log scores of each document; its own n-grams are not among those it is scored by."""
        others = []
        for number, at in zip(self.number, self.at):
            pair = self.document[at] * len(self.grams) + number[at]
            _, inverse, own = np.unique(pair, return_inverse=True, return_counts=True)
            found = np.zeros(len(number), np.int64)
            found[at] = totals[number[at]] - own[inverse]
            others.append(found)
        rest = (corpus_words - sizes)[self.document]
        # words that no other document has count once in all
        score = np.log(np.maximum(others[0], 1)) - np.log(rest + 1)
        for n in range(1, len(others)):
            context = np.concatenate(([0], others[n - 1][:-1])) if len(rest) else others[0]
            seen = (others[n] > 0) & (context > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                direct = np.log(others[n]) - np.log(context)
            score = np.where(seen, direct, np.where(self.at[n], score + math.log(backoff), score))
        return np.bincount(self.document, weights=score, minlength=len(sizes))


def _blocks(docs: DataFrame, path: str) -> DataFrame:
    """Writes and rereads the documents in blocks: block, doc_ids, vocabulary (hashes), words, sizes, n_words.

    The table is bucketed by block, so that scoring brings the answers to the blocks and shuffles no block.
    """
    schema = T.StructType(
        [T.StructField("block", T.LongType()), T.StructField("doc_ids", T.ArrayType(docs.schema["doc_id"].dataType))]
        + [T.StructField(n, T.BinaryType()) for n in ("vocabulary", "words", "sizes")]
        + [T.StructField("n_words", T.LongType())]
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            sizes = pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False)
            numbers = np.cumsum(sizes) // BLOCK_CHARS
            for number in np.unique(numbers):
                rows = np.flatnonzero(numbers == number)
                part = batch.slice(rows[0], len(rows))
                split = pc.ascii_split_whitespace(part.column(1).cast(pa.large_string()))
                words = split.flatten()
                document = np.repeat(np.arange(len(part)), np.diff(split.offsets.to_numpy()))
                kept = pc.not_equal(words, "")
                document = document[kept.to_numpy(zero_copy_only=False)]
                coded = words.filter(kept).dictionary_encode()
                hashes = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
                order = np.argsort(hashes)
                rank = np.empty(len(order), np.uint32)
                rank[order] = np.arange(len(order), dtype=np.uint32)
                codes = coded.indices.to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block]),
                        pa.array([part.column(0).to_pylist()], pa.list_(part.column(0).type)),
                        pa.array([_pack(np.diff(hashes[order], prepend=np.uint64(0)))]),
                        pa.array([_pack(rank[codes])]),
                        pa.array([_pack(np.bincount(document, minlength=len(part)).astype(np.int64))]),
                        pa.array([len(document)]),
                    ],
                    names=schema.names,
                )
                block += 1

    spark = docs.sparkSession
    name, buckets = f"blocks_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    written = docs.select("doc_id", whole_text().alias("text")).mapInArrow(task, schema)
    written.write.bucketBy(buckets, "block").option("path", path).saveAsTable(name)
    found = spark.table(name)
    found.schema  # the files and their buckets are known from here on; the name isn't needed any more
    spark.sql(f"DROP TABLE {name}")
    return found


def _opened(row: dict, order: int) -> tuple[Block, np.ndarray]:
    sizes = _unpack(row["sizes"], np.int64)
    return Block(np.cumsum(_unpack(row["vocabulary"], np.uint64), dtype=np.uint64), _unpack(row["words"], np.uint32), sizes, order), sizes


def scores(docs: DataFrame, order: int = ORDER, backoff: float = BACKOFF) -> DataFrame:
    """doc_id, n_words, log_score (the sum of the log scores of its words) and mean_log_score of every whole text.

    A word after its context scores count(context, word) / count(context); where that n-gram doesn't occur, `backoff`
    times the score after a shorter context; alone, its count by all words, or 1 where it doesn't occur, the words
    counting one more. All counts are those of the other documents, taken over the whole table; copies count as others.
    Count tables are partitioned by ranges of n-gram hashes; each block adds up its own n-grams first, so a frequent one is one
    number of each block. A text without words (or a null one) has score 0 and a null mean; rows alike are scored each;
    an empty table gives no row.
    """
    spark = docs.sparkSession
    ship(spark)
    blocks = _blocks(docs, scratch_path(spark, "blocks"))
    corpus_words = blocks.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]

    def packets_of(own: Block, block: int, round_: int, elsewhere: np.ndarray) -> pd.DataFrame:
        """What a block sends in a round, one row for each hash range."""
        lengths = min(order, 2) if not round_ else 1
        bits = max(0, math.ceil(math.log2(max(1, corpus_words * lengths / RANGE_GRAMS))))
        sent = own.sent(round_, elsewhere)
        grams, counts = own.grams[sent], own.counts()[sent].astype(np.uint32)
        place = (grams >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(grams), np.int64)
        bounds, rows = np.searchsorted(place, np.arange((1 << bits) + 1)), []
        for r in np.flatnonzero(np.diff(bounds)).tolist():
            some = slice(bounds[r], bounds[r + 1])
            rows.append((r, block, _pack(np.diff(grams[some], prepend=np.uint64(0))), _pack(counts[some])))
        return pd.DataFrame(rows, columns=["range", "block", "grams", "counts"])

    def ask_first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                own, _ = _opened(row, min(order, 2))
                yield packets_of(own, row["block"], 0, np.zeros(0))

    def ask(round_: int):
        def task(asked: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
            own, _ = _opened(asked.iloc[0].to_dict(), round_ + 2)
            return packets_of(own, asked["block"].iloc[0], round_, own.elsewhere(answers))

        return task

    def answer(packets: pd.DataFrame) -> pd.DataFrame:
        # the count table of one hash range
        grams = [np.cumsum(_unpack(g, np.uint64), dtype=np.uint64) for g in packets["grams"]]
        counts = np.concatenate([_unpack(c, np.uint32) for c in packets["counts"]])
        table, inverse = np.unique(np.concatenate(grams), return_inverse=True)
        totals = np.bincount(inverse, weights=counts, minlength=len(table)).astype(np.int64)[inverse]
        # the asker knows its own counts; what other blocks add is zero for most n-grams, so it packs small
        parts = np.split(totals - counts, np.cumsum([len(g) for g in grams])[:-1])
        return pd.DataFrame({"block": packets["block"], "range": packets["range"], "elsewhere": [_pack(p) for p in parts]})

    key = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", key), T.StructField("n_words", T.LongType()), T.StructField("log_score", T.DoubleType())])

    def score(asked: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        row = asked.iloc[0].to_dict()
        own, sizes = _opened(row, order)
        totals = own.counts() + own.elsewhere(answers)
        return pd.DataFrame({"doc_id": row["doc_ids"], "n_words": sizes, "log_score": own.scores(totals, corpus_words, sizes, backoff)})

    coded, packet = blocks.select("block", "vocabulary", "words", "sizes"), "range int, block long, grams binary, counts binary"
    answers = None
    for round_ in range(max(1, order - 1)):
        if answers is None:
            packets = coded.mapInPandas(ask_first, packet)
        else:
            packets = coded.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(ask(round_), packet)
        answered = packets.groupBy("range").applyInPandas(answer, "block long, range int, elsewhere binary")
        answered = staged(answered.withColumn("round", F.lit(round_)), "answers")
        answers = answered if answers is None else answers.union(answered)
    scored = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(score, schema)
    return scored.select("*", (F.col("log_score") / F.nullif("n_words", F.lit(0))).alias("mean_log_score"))
