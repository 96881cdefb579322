"""Two tokenizers aligned over whole texts, and how often their tokens are linked in the corpus.

Blocks of documents write their pair-document records as zstd runs, parted by radix. Runs of a radix are merged by a heap,
which counts each pair of ids; in the order of the first tokenizer's ids the highest count of an id is known when its last
pair has passed. Counts go back to the runs that hold the pairs, and the records in them give each document its share.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.llm.shared import ship, whole_text
from basketlens.llm.tokens import portions
from basketlens.session import staged

#: Bytes of text in a block, unless one text is longer.
BLOCK = 4_000_000
#: Different words that a worker remembers (some 400 bytes each); beyond that it keeps those that have come up again.
REMEMBERED = 150_000
#: Records are parted by the first tokenizer's id modulo RADIX.
RADIX = 64
#: Runs that are merged at once; more are merged in levels.
FAN_IN = 512

#: Texts in which a space (one stands before the text too) is followed by white space or by nothing are encoded whole.
_WHOLE = r"(?:\A| )(?:[\s\x0B\x1C-\x1F]|\z|[\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}])"

#: Tokens of A and of B, groups, the groups as text, and the links (id of A, id of B in one number) of a piece of text.
Piece = tuple[int, int, int, str, bytes]
_NOTHING: Piece = (0, 0, 0, "", b"")


def _byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: visible ones for themselves, the others moved up."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    moved = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(moved)}


def _piece_bytes(piece: str) -> bytes:
    return piece.replace("▁", " ").encode()


class Aligner:
    """Aligns the tokens of a byte-level BPE file (A) and of a sentencepiece model (B) over a space and a text."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=b_path)
        alphabet, names = _byte_alphabet(), {i: t for t, i in self.a.get_vocab().items()}
        self.a_bytes = [bytes(alphabet[c] for c in names.get(i, "") if c in alphabet) for i in range(max(names) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else _piece_bytes(p) for i, p in enumerate(pieces)]
        self.a_width, self.b_width = (np.array([len(x) for x in y], np.int64) for y in (self.a_bytes, self.b_bytes))
        self.known: dict[str, Piece | None] = {}

    def learn(self, words: list[str]) -> list[Piece | None]:
        """The alignment of a space and each word; None where the bytes of both don't agree with it."""
        each_a = [x.ids for x in self.a.encode_batch_fast([f" {w}" for w in words], add_special_tokens=False)]
        each_b = self.b.encode(words) if words else []
        given = [f" {w}".encode() for w in words]
        fits = self._fits(given, each_a, each_b)
        if not fits.all():
            each_a, each_b = ([x for x, fit in zip(each, fits) if fit] for each in (each_a, each_b))
        pieces = self._aligned(each_a, each_b)
        return [next(pieces) if fit else None for fit in fits]

    def _fits(self, given: list[bytes], each_a: list[list[int]], each_b: list[list[int]]) -> np.ndarray:
        """Whether the bytes of both tokenizations are those given."""
        sizes, whole, alike = np.array(list(map(len, given))), b"".join(given), True
        for each, known, width in ((each_a, self.a_bytes, self.a_width), (each_b, self.b_bytes, self.b_width)):
            ids = [i for x in each for i in x]
            ends = np.concatenate(([0], np.cumsum(width[ids]) if ids else []))[np.cumsum(list(map(len, each)), dtype=np.int64)]
            alike = alike and bool((ends == np.cumsum(sizes)).all()) and b"".join(map(known.__getitem__, ids)) == whole
        if alike:
            return np.ones(len(given), bool)

        def joined(ids: list[int], known: list[bytes]) -> bytes:
            return b"".join(known[i] for i in ids)

        return np.array([joined(a, self.a_bytes) == x == joined(b, self.b_bytes) for x, a, b in zip(given, each_a, each_b)], bool)

    def _aligned(self, each_a: list[list[int]], each_b: list[list[int]]) -> Iterator[Piece]:
        """All texts are aligned in one go, laid end to end, as both tokenizations of each end together."""
        a, b = (np.array([i for x in each for i in x], np.int64) for each in (each_a, each_b))
        a_ends, b_ends = np.cumsum(self.a_width[a]), np.cumsum(self.b_width[b])
        a_starts, b_starts = a_ends - self.a_width[a], b_ends - self.b_width[b]
        # the tokens of B that each token of A overlaps follow each other
        first, after = np.searchsorted(b_ends, a_starts, "right"), np.searchsorted(b_starts, a_ends, "left")
        number = after - first
        link_a = np.repeat(a, number)
        link_b = b[np.arange(len(link_a)) + np.repeat(first - np.cumsum(number) + number, number)]
        codes = (link_a.astype(np.uint64) << np.uint64(32)) | link_b.astype(np.uint64)
        links = np.concatenate(([0], np.cumsum(number)))
        cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
        a_cuts, b_cuts = (np.concatenate(([0], np.searchsorted(ends, cuts, "right"))).tolist() for ends in (a_ends, b_ends))
        a_text, b_text = list(map(str, a.tolist())), list(map(str, b.tolist()))
        groups = [
            f"{','.join(a_text[i:j])}|{','.join(b_text[k:m])}" for i, j, k, m in zip(a_cuts, a_cuts[1:], b_cuts, b_cuts[1:])
        ]
        a_to = np.cumsum([0, *map(len, each_a)])
        ends = np.concatenate(([0], a_ends))[a_to]
        g_to = np.searchsorted(cuts, ends, "right").tolist()
        links_to = links[a_to].tolist()
        data = codes.tobytes()
        for i, (own_a, own_b) in enumerate(zip(each_a, each_b)):
            text = ";".join(groups[g_to[i] : g_to[i + 1]])
            yield len(own_a), len(own_b), g_to[i + 1] - g_to[i], text, data[8 * links_to[i] : 8 * links_to[i + 1]]

    def whole(self, text: str) -> Piece:
        return self.learn([text])[0] or _NOTHING

    def pieces(self, texts: pa.Array) -> tuple[list[Piece], np.ndarray, np.ndarray]:
        """Different pieces, those of all texts one after the other (their numbers), and where each text's begin.

        A text is taken apart before its spaces: A starts a token there, and no piece of B goes on across one. Each
        different word is aligned once. Texts with other white space behind a space, or with a word whose bytes don't
        agree, are one piece.
        """
        texts = texts.cast(pa.large_string())
        alone = pc.match_substring_regex(texts, _WHOLE).to_numpy(zero_copy_only=False)
        split = pc.split_pattern(texts, " ")
        words = split.flatten().dictionary_encode()
        different = words.dictionary.to_pylist()
        new = [w for w in different if w and w not in self.known]
        again = [w for w in different if w in self.known] if len(self.known) + len(new) > REMEMBERED else None
        for i in range(0, len(new), 5_000):
            self.known.update(zip(new[i : i + 5_000], self.learn(new[i : i + 5_000])))
        found = [self.known.get(w) for w in different]
        usable = np.array([x is not None for x in found], bool)
        numbers, bounds = words.indices.to_numpy(), split.offsets.to_numpy() - split.offsets[0].as_py()
        listed, out = [x or _NOTHING for x in found], []
        for i in range(len(texts)):
            own = numbers[bounds[i] : bounds[i + 1]]
            if alone[i] or not usable[own].all():
                text = texts[i].as_py()
                own = np.array([len(listed)] if text else [], np.int64)
                listed += [self.whole(text)] if text else []
            out.append(own)
        if again is not None:
            self.known = {w: self.known[w] for w in again}
        return listed, np.concatenate([np.zeros(0, np.int64), *out]), np.cumsum([0, *map(len, out)])


@functools.lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    """The aligner of this worker; what it has learned serves later tasks too."""
    return Aligner(a_path, b_path)


def _frozen(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers in a zstd frame, each in the fewest bytes that hold its greatest one."""
    import zstandard

    parts = []
    for x in arrays:
        kind = np.min_scalar_type(int(x.max(initial=0)))
        parts += [np.array([kind.itemsize, len(x)], "<u8").tobytes(), x.astype(kind.newbyteorder("<")).tobytes()]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def _thawed(blob: bytes) -> list[np.ndarray]:
    import zstandard

    data, at, found = zstandard.ZstdDecompressor().decompress(blob), 0, []
    while at < len(data):
        size, length = np.frombuffer(data, "<u8", 2, at).tolist()
        found.append(np.frombuffer(data, f"<u{size}", length, at + 16).astype(np.int64))
        at += 16 + size * length
    return found


def _opened(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Pairs and counts of a run."""
    steps, counts = _thawed(blob)
    return np.cumsum(steps), counts


def _run(keys: np.ndarray, counts: np.ndarray) -> bytes:
    return _frozen(np.diff(keys, prepend=0), counts)


def _records(codes: np.ndarray, docs: np.ndarray, shift: int) -> list[tuple[int, bytes, bytes]]:
    """For each radix that occurs: its run of pairs with their numbers of documents, and its documents and times by pair.

    A pair's key is the rest of A's id above `shift` bits for that of B, so a run goes by A, then by B."""
    a, b = codes >> np.uint64(32), codes & np.uint64(0xFFFFFFFF)
    doc_bits = np.uint64(int(docs.max(initial=0)).bit_length())
    key_bits = np.uint64(int(a.max(initial=0)).bit_length() + shift)
    keys = ((a // np.uint64(RADIX)) << np.uint64(shift)) | b
    # one number for radix, pair and document: blocks are small enough for 64 bits
    sorted_ = np.sort((((a % np.uint64(RADIX)) << key_bits | keys) << doc_bits) | docs.astype(np.uint64))
    docs = (sorted_ & ((np.uint64(1) << doc_bits) - np.uint64(1))).astype(np.int64)
    sorted_ >>= doc_bits
    keys = (sorted_ & ((np.uint64(1) << key_bits) - np.uint64(1))).astype(np.int64)
    radix = (sorted_ >> key_bits).astype(np.int64)
    new_pair = np.ones(len(keys), bool)
    new_pair[1:] = sorted_[1:] != sorted_[:-1]
    new = new_pair.copy()
    new[1:] |= docs[1:] != docs[:-1]
    at = np.flatnonzero(new)
    times = np.diff(at, append=len(keys))
    new_pair, radix, keys, docs = new_pair[at], radix[at], keys[at], docs[at]
    # documents of a pair ascend, so what is kept are steps
    steps = np.where(new_pair, docs, np.diff(docs, prepend=0))
    pairs = np.flatnonzero(new_pair)
    found = []
    for r in np.unique(radix).tolist():
        begin, end = np.searchsorted(radix, [r, r + 1])
        own = pairs[np.searchsorted(pairs, begin) : np.searchsorted(pairs, end)]
        found.append((r, _run(keys[own], np.diff(own, append=end)), _frozen(steps[begin:end], times[begin:end])))
    return found


def _merged(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of some runs in ascending order, with the sums of their counts, by a heap over the runs."""

    def read(blob: bytes) -> Iterator[int]:
        keys, counts = _opened(blob)
        for i in range(0, len(keys), 4096):
            yield from (k << 40 | n for k, n in zip(keys[i : i + 4096].tolist(), counts[i : i + 4096].tolist()))

    keys: list[int] = []
    counts: list[int] = []
    last = -1
    for both in heapq.merge(*map(read, blobs)):
        key = both >> 40
        if key == last:
            counts[-1] += both & 0xFF_FFFF_FFFF
        else:
            keys.append(key)
            counts.append(both & 0xFF_FFFF_FFFF)
            last = key
    return np.array(keys, np.int64), np.array(counts, np.int64)


def _highest(keys: np.ndarray, counts: np.ndarray, shift: int) -> np.ndarray:
    """Whether the count of each pair is the highest of its id of A; pairs go by A."""
    if not len(keys):
        return np.zeros(0, bool)
    starts = np.flatnonzero(np.diff(keys >> shift, prepend=-1))
    return counts == np.repeat(np.maximum.reduceat(counts, starts), np.diff(starts, append=len(keys)))


_RUNS = "run long, radix int, pairs binary"
_ANSWERS = "run long, radix int, answer binary"


def _answers(table: pa.Table, keys: np.ndarray, counts: np.ndarray, best: np.ndarray) -> pa.Table:
    """What each run of a table learns of its pairs."""
    found = []
    for blob in table.column("pairs"):
        at = np.searchsorted(keys, _opened(blob.as_py())[0])
        found.append(_frozen(counts[at], best[at]))
    columns = {"run": table.column("run"), "radix": table.column("radix"), "answer": pa.array(found, pa.binary())}
    return pa.table(columns).cast(pa.schema([("run", pa.int64()), ("radix", pa.int32()), ("answer", pa.binary())]))


def _counted(runs: DataFrame, number: int, shift: int, fan_in: int) -> DataFrame:
    """For each run the corpus-wide count of each of its pairs and whether it is the highest of its id of A.

    Up to `fan_in` runs of a radix are merged by one task. More are merged by groups first; the runs of these merges are
    counted in the same way, and what is found comes back to the runs of a group from its merge.
    """
    if number <= fan_in:

        def root(table: pa.Table) -> pa.Table:
            keys, counts = _merged([x.as_py() for x in table.column("pairs")])
            return _answers(table, keys, counts, _highest(keys, counts, shift))

        return runs.groupBy("radix").applyInArrow(root, _ANSWERS)
    groups = -(-number // fan_in)
    dealt = runs.withColumn("parent", F.pmod(F.xxhash64("run"), F.lit(groups)).cast("long"))

    def merge(table: pa.Table) -> pa.Table:
        blob = _run(*_merged([x.as_py() for x in table.column("pairs")]))
        columns = {"run": table.column("parent")[:1], "radix": table.column("radix")[:1], "pairs": pa.array([blob], pa.binary())}
        return pa.table(columns)

    merged = staged(dealt.groupBy("parent", "radix").applyInArrow(merge, _RUNS), "merged")
    above = merged.join(_counted(merged, groups, shift, fan_in), ["run", "radix"]).withColumnRenamed("run", "parent")

    def down(own: pa.Table, parent: pa.Table) -> pa.Table:
        keys, _ = _opened(parent.column("pairs")[0].as_py())
        counts, best = _thawed(parent.column("answer")[0].as_py())
        return _answers(own, keys, counts, best)

    return dealt.groupBy("parent", "radix").cogroup(above.groupBy("parent", "radix")).applyInArrow(down, _ANSWERS)


_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


def _blocks(docs: DataFrame, a_path: str, b_path: str, block: int) -> DataFrame:
    """A row for each block: block, of its documents doc_id, the _NUMBERS and groups_sha256 as lists, and by radix the runs
    of pairs and the records."""
    key = docs.schema["doc_id"].dataType
    fields = [T.StructField("doc_id", T.ArrayType(key))]
    fields += [T.StructField(n, T.ArrayType(T.LongType())) for n in _NUMBERS]
    fields += [T.StructField("groups_sha256", T.ArrayType(T.StringType())), T.StructField("radix", T.ArrayType(T.IntegerType()))]
    fields += [T.StructField(n, T.ArrayType(T.BinaryType())) for n in ("pairs", "records")]
    schema = T.StructType([T.StructField("block", T.LongType()), *fields])

    def one(values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    def row(number: int, names: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        tool = aligner(a_path, b_path)
        pieces, numbers, bounds = tool.pieces(texts)
        groups = [p[3] for p in pieces]
        sizes = np.array([[p[0], p[1], p[2], len(p[4]) // 8] for p in pieces], np.int64).reshape(-1, 4)
        sums = np.concatenate((np.zeros((1, 4), np.int64), np.cumsum(sizes[numbers], axis=0)))
        totals = sums[bounds[1:]] - sums[bounds[:-1]]
        digests = []
        for i, (begin, end) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            own = ";".join([groups[k] for k in numbers[begin:end].tolist()])
            digests.append(hashlib.sha256(own.encode()).hexdigest() if totals[i, 0] else "")
        links = pa.LargeListArray.from_arrays(
            pa.array(np.concatenate(([0], np.cumsum(sizes[:, 3]))), pa.int64()), pa.array(np.frombuffer(b"".join(p[4] for p in pieces), np.uint64))
        )
        codes = links.take(pa.array(numbers)).flatten().to_numpy()
        records = _records(codes, np.repeat(np.arange(len(texts)), totals[:, 3]), _shift(tool))
        columns = [names, *[pa.array(totals[:, k]) for k in range(4)], pa.array(digests, pa.string())]
        columns += [pa.array([r for r, _, _ in records], pa.int32())]
        columns += [pa.array([x[k] for x in records], pa.binary()) for k in (1, 2)]
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *map(one, columns)], names=schema.names)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in portions(batch, most=block):
                yield row(number, part.column(0), part.column(1))
                number += 1

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(task, schema)


def _shift(tool: Aligner) -> int:
    return len(tool.b_bytes).bit_length()


def _shares(length: int, pairs: list[bytes], records: list[bytes], answers: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """n_best and count_sum of the documents of a block."""
    best_links, count_sum = np.zeros(length, np.int64), np.zeros(length, np.int64)
    for run, own, answer in zip(pairs, records, answers):
        number = _opened(run)[1]
        steps, times = _thawed(own)
        counts, best = (np.repeat(x, number) for x in _thawed(answer))
        walked = np.cumsum(steps)
        starts = np.cumsum(number) - number
        docs = walked - np.repeat(walked[starts] - steps[starts], number)
        np.add.at(best_links, docs, times * best)
        np.add.at(count_sum, docs, times * counts)
    return best_links, count_sum


def alignment(docs: DataFrame, a_path: str, b_path: str, block: int = BLOCK, fan_in: int = FAN_IN) -> DataFrame:
    """How the tokens of two tokenizers over a space and each whole text are linked, one row for each of docs.

    a_path: a byte-level BPE file (special tokens in a text are plain text), b_path: a sentencepiece model, both on the
    executors. doc_id, n_a and n_b (tokens), n_groups (cuts where tokens of both end), n_links (pairs of tokens whose bytes
    overlap), n_best (links whose pair of ids is linked in the highest number of documents of all pairs with that id of
    A), count_sum (these numbers over all links), groups_sha256 (of the groups' ids).

    A null or empty text, or one that a tokenizer changes, has no tokens: zeros and ''. A text longer than `block` bytes is a
    block of its own. Repeated rows are documents of their own; a null doc_id stays null; an empty table gives no row. Other
    columns are not looked at. A hot pair is one entry for each block, merged `fan_in` at a time.
    """
    spark = docs.sparkSession
    ship(spark)
    blocks = staged(_blocks(docs, a_path, b_path, block), "aligned")
    runs = blocks.select(F.col("block").alias("run"), F.explode(F.arrays_zip("radix", "pairs")).alias("x"))
    shift = _shift(aligner(a_path, b_path))
    found = _counted(runs.select("run", "x.radix", "x.pairs"), blocks.count(), shift, fan_in)
    # at most RADIX answers a block
    by_block = found.groupBy(F.col("run").alias("block")).agg(F.sort_array(F.collect_list(F.struct("radix", "answer"))).alias("found"))
    joined = blocks.join(by_block, "block", "left").select(
        "doc_id", *_NUMBERS, "groups_sha256", "pairs", "records", F.coalesce(F.col("found.answer"), F.array().cast("array<binary>")).alias("answers")
    )
    last = [T.StructField(n, T.LongType()) for n in (*_NUMBERS, "n_best", "count_sum")]
    schema = T.StructType([docs.select("doc_id").schema[0], *last, T.StructField("groups_sha256", T.StringType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own = batch.slice(i, 1)
                names, *numbers, digests = (own.column(k).flatten() for k in range(6))
                shares = _shares(len(names), *[own.column(k)[0].as_py() for k in (6, 7, 8)])
                columns = [names, *numbers, *map(pa.array, shares), digests]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return joined.mapInArrow(task, schema)
