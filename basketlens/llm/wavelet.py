"""Token ids as one wavelet matrix per shard file: access, counting and occurrence lookup without decoding it."""

from __future__ import annotations

import json
import struct
import uuid
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketlens.llm.shared import ship, whole_text
from basketlens.llm.tokens import encoder, ended, portions

# Fixed values of the file format. Bytes: magic, uint32 size of the header, header (JSON), then the parts
# that the header places, each compressed with zstandard.
MAGIC = b"WVM1"
#: Bits of a plane that are compressed together, and bits between two entries of its rank directory.
BLOCK, STEP = 1 << 16, 1 << 12
SUFFIX = ".wvm"


def _bools(bits: np.ndarray, size: int) -> pa.Array:
    return pa.Array.from_buffers(pa.bool_(), size, [None, pa.py_buffer(bits)])


def encode(ids: np.ndarray, doc_ids: np.ndarray, nulls: np.ndarray, lengths: np.ndarray) -> bytes:
    """A shard file: the ids of its documents one after the other, their names (nulls: which have none) and lengths."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=1).compress
    parts: list[bytes] = []
    end = 0
    planes = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    values = pa.array(ids.astype(np.uint16 if planes <= 16 else np.uint32))
    header = {"n": len(ids), "docs": len(lengths), "planes": []}

    def put(data: bytes) -> list[int]:
        nonlocal end
        parts.append(pack(data))
        end += len(parts[-1])
        return [end - len(parts[-1]), len(parts[-1])]

    for level in range(planes - 1, -1, -1):
        flags = ((values.to_numpy() >> level) & 1).astype(np.uint8)
        bits = np.packbits(flags, bitorder="little")
        padded = np.pad(flags, (0, -len(flags) % STEP)).reshape(-1, STEP)
        ranks = np.concatenate(([0], np.cumsum(padded.sum(axis=1, dtype=np.int64))))
        mask = _bools(bits, len(flags))
        zeros = values.filter(pc.invert(mask))
        header["planes"].append(
            {
                "zeros": len(zeros),
                "ranks": put(ranks.astype("<u4").tobytes()),
                "blocks": [put(bits[i : i + BLOCK // 8].tobytes()) for i in range(0, len(bits), BLOCK // 8)],
            }
        )
        values = pa.concat_arrays([zeros, values.filter(mask)])
    header["doc_ids"] = put(doc_ids.astype("<i8").tobytes())
    header["nulls"] = put(nulls.astype(np.uint8).tobytes())
    header["lengths"] = put(lengths.astype("<i8").tobytes())
    text = json.dumps(header, separators=(",", ":")).encode()
    return b"".join([MAGIC, struct.pack("<I", len(text)), text, *parts])


class Shard:
    """Reads a shard file given as bytes (or a memory map); planes are decompressed block by block when needed."""

    def __init__(self, data, remembered: int = 64):
        import zstandard

        self._unpack = zstandard.ZstdDecompressor().decompress
        self.data, self._cache, self._most = memoryview(data), OrderedDict(), remembered
        if bytes(self.data[:4]) != MAGIC:
            raise ValueError("not a wavelet shard")
        size = struct.unpack("<I", self.data[4:8])[0]
        self.header = json.loads(bytes(self.data[8 : 8 + size]))
        self._base, self.n, self.planes = 8 + size, self.header["n"], self.header["planes"]

    def _part(self, place: list[int]) -> bytes:
        key = place[0]
        if key not in self._cache:
            self._cache[key] = self._unpack(self.data[self._base + key : self._base + key + place[1]])
            if len(self._cache) > self._most:
                self._cache.popitem(last=False)
        self._cache.move_to_end(key)
        return self._cache[key]

    def _numbers(self, place: list[int], kind: str) -> np.ndarray:
        return np.frombuffer(self._part(place), kind)

    @property
    def doc_ids(self) -> pa.Array:
        return pa.array(self._numbers(self.header["doc_ids"], "<i8"), mask=self._numbers(self.header["nulls"], "u1") != 0)

    @property
    def lengths(self) -> np.ndarray:
        return self._numbers(self.header["lengths"], "<i8")

    def _bits(self, plane: dict, begin: int, end: int) -> np.ndarray:
        """The bits begin to end, both in one stretch of the rank directory."""
        block = np.frombuffer(self._part(plane["blocks"][begin // BLOCK]), np.uint8)
        at = begin % BLOCK
        return np.unpackbits(block[at // 8 : (at % BLOCK + end - begin + 7) // 8], bitorder="little")[: end - begin]

    def _ones(self, plane: dict, i: int) -> int:
        """Ones before position i."""
        found = int(self._numbers(plane["ranks"], "<u4")[i // STEP])
        begin = i - i % STEP
        return found + int(self._bits(plane, begin, i).sum()) if i > begin else found

    def _find(self, plane: dict, bit: int, k: int) -> int:
        """Position of the k-th (from 0) such bit."""
        ranks = self._numbers(plane["ranks"], "<u4").astype(np.int64)
        if not bit:
            ranks = np.minimum(np.arange(len(ranks)) * STEP, self.n) - ranks
        step = int(np.searchsorted(ranks, k, side="right")) - 1
        begin = step * STEP
        bits = self._bits(plane, begin, min(begin + STEP, self.n))
        return begin + int(np.flatnonzero(bits == bit)[k - ranks[step]])

    def access(self, i: int) -> int:
        """The id at position i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for plane in self.planes:
            begin = i - i % STEP
            bit = int(self._bits(plane, begin, i + 1)[-1])
            ones = self._ones(plane, i)
            value = value << 1 | bit
            i = plane["zeros"] + ones if bit else i - ones
        return value

    def _range(self, token: int, begin: int, end: int) -> tuple[int, int]:
        if token < 0 or token >> len(self.planes):
            return 0, 0
        for k, plane in enumerate(self.planes):
            a, b = self._ones(plane, begin), self._ones(plane, end)
            if token >> (len(self.planes) - 1 - k) & 1:
                begin, end = plane["zeros"] + a, plane["zeros"] + b
            else:
                begin, end = begin - a, end - b
        return begin, end

    def count(self, token: int, begin: int = 0, end: int | None = None) -> int:
        """How often the id occurs from begin up to end."""
        if not self.n:
            return 0
        first, last = self._range(token, begin, self.n if end is None else end)
        return last - first

    def locate(self, token: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of the id."""
        if not 0 <= k < self.count(token):
            raise IndexError(k)
        i = self._range(token, 0, self.n)[0] + k
        for level, plane in enumerate(reversed(self.planes)):
            bit = token >> level & 1
            i = self._find(plane, bit, i - plane["zeros"] if bit else i)
        return i

    def decode(self) -> np.ndarray:
        """All ids (uint32)."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        values = np.zeros(self.n, kind)
        for level, plane in enumerate(reversed(self.planes)):
            bits = b"".join(self._unpack(self.data[self._base + a : self._base + a + size]) for a, size in plane["blocks"])
            flags = np.unpackbits(np.frombuffer(bits, np.uint8), count=self.n, bitorder="little").view(bool)
            values[plane["zeros"] :] |= kind(1 << level)
            before = np.empty_like(values)
            before[np.flatnonzero(~flags)] = values[: plane["zeros"]]
            before[np.flatnonzero(flags)] = values[plane["zeros"] :]
            values = before
        return values.astype(np.uint32)


def write_shards(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, shard_ids: int = 1 << 22) -> DataFrame:
    """Encodes whole texts in ascending doc_id order and writes them as wavelet shards into a folder that driver
    and executors share (a path or URI).

    A shard takes documents until it has `shard_ids` ids; one task writes the shards of one range of doc_id.
    Files get their final name when they are complete, so a repeated task replaces what an earlier attempt left.
    Null doc_ids come first, equal ones in the order of their texts; a null text is the end id alone; an empty
    table gives no file. Returns the manifest (also kept in the folder): shard, start (ids before it), n_docs, n_tokens.
    """
    ship(docs.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        partition, pending, held, number = TaskContext.get().partitionId(), [], 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal pending, held, number
            name = f"{partition:08d}-{number:08d}"
            names = pa.concat_arrays([n for n, _ in pending])
            ids = [x for _, part in pending for x in part]
            lengths = np.array([len(x) for x in ids], np.int64)
            nulls = names.is_null().to_numpy(zero_copy_only=False)
            data = encode(np.concatenate(ids), names.fill_null(0).to_numpy(), nulls, lengths)
            _store(folder, name + SUFFIX, data)
            row = {"partition": [partition], "number": [number], "shard": [name], "n_docs": [len(ids)], "n_tokens": [held]}
            pending, held, number = [], 0, number + 1
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            for part in portions(batch):
                ids = ended(*encoder(tokenizer).encode(part.column(1)), end_id)
                begin = 0
                for i, own in enumerate(ids):
                    held += len(own)
                    if held >= shard_ids:
                        pending.append((part.column(0).slice(begin, i + 1 - begin), ids[begin : i + 1]))
                        begin = i + 1
                        yield flush()
                if begin < len(ids):
                    pending.append((part.column(0).slice(begin), ids[begin:]))
        if pending:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    written = ordered.mapInArrow(task, "partition long, number long, shard string, n_docs long, n_tokens long")
    written.write.parquet(f"{folder}/_written")
    before = Window.orderBy("partition", "number").rowsBetween(Window.unboundedPreceding, -1)
    manifest = docs.sparkSession.read.schema(written.schema).parquet(f"{folder}/_written").select(
        "shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start"), "n_docs", "n_tokens"
    )
    # one row per shard; written so that readers know its size
    manifest.write.parquet(f"{folder}/_manifest")
    return docs.sparkSession.read.parquet(f"{folder}/_manifest")


def _store(folder: str, name: str, data: bytes) -> None:
    """Writes a file under another name first: readers never see half of it."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith(("/", "file:")) else f"/{folder}")
    system.create_dir(path, recursive=True)
    hidden = f"{path}/_{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(hidden) as out:
        out.write(data)
    if system.get_file_info(f"{path}/{name}").type != fs.FileType.NotFound and system.type_name == "hdfs":
        system.delete_file(f"{path}/{name}")
    system.move(hidden, f"{path}/{name}")


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of a folder of shards, decoded: doc_id, start (ids of all documents before it), n_tokens and
    ids (little-endian unsigned 32-bit)."""
    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{SUFFIX}").load(folder)
    named = files.select(F.regexp_extract("path", r"([^/]+)\.wvm$", 1).alias("shard"), "content")
    placed = named.join(spark.read.parquet(f"{folder}/_manifest").select("shard", "start"), "shard")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, first in zip(batch.column(0), batch.column(1)):
                shard = Shard(content.as_buffer())
                ids, lengths, names = shard.decode().astype("<u4"), shard.lengths, shard.doc_ids
                ends = np.cumsum(lengths)
                starts = ends - lengths
                for i in range(0, len(lengths), 1000):
                    some = slice(i, i + 1000)
                    parts = [ids[a:b].tobytes() for a, b in zip(starts[some].tolist(), ends[some].tolist())]
                    columns = [names[some], pa.array(starts[some] + first.as_py()), pa.array(lengths[some]), pa.array(parts, pa.binary())]
                    yield pa.record_batch(columns, names=["doc_id", "start", "n_tokens", "ids"])

    return placed.select("content", "start").mapInArrow(task, "doc_id long, start long, n_tokens long, ids binary")


def documents_digest(documents: DataFrame) -> DataFrame:
    """Decoded documents with the CRC-32 of their ids instead of the ids."""
    return documents.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))

