"""Sum-of-squares packing of token ids into windows of one length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.llm.shared import ship, whole_text
from basketlens.llm.tokens import encoder, ended, portions

#: (row, start, ids): ids of the document in that row, from the id at start on.
Piece = tuple[int, int, np.ndarray]


class Levels:
    """Open windows by their fill level, filled online.

    What arrives goes to the level, or to a new window, after which the sum of the squared numbers of windows
    on each level is least; full windows don't count. A level takes `most` windows. What would have to go beyond
    that is cut: it completes the window, and leaves the rest on the level, after which the sum is least. With
    `most` windows on a level there is always such a step that doesn't raise the sum, so no level ever exceeds
    `most` and fewer than most * window windows are open, whatever the lengths are.
    """

    def __init__(self, window: int, most: int = 4):
        self.window, self.most = window, most
        self.counts = np.zeros(window + 1)
        self.counts[window] = -0.5  # a filled window adds nothing: 2 * (-0.5 - n) + 2 is 1 - 2 n
        self.windows: list[list[list[Piece]]] = [[] for _ in range(window)]

    def place(self, pieces: list[Piece], fresh: bool = True) -> Iterator[list[Piece]]:
        """Takes pieces, together shorter than a window; gives the windows that are full now.

        Without `fresh` no new window is opened and levels take any number, as nothing more follows.
        """
        size, window = sum(len(ids) for _, _, ids in pieces), self.window
        counts, whole = self.counts, self.window - size
        # for each level that leaves room: its windows, and those of the level it would become
        own, after = counts[1 : whole + 1], counts[size + 1 :]
        change = 2 * (after - own) + 2
        change[(own <= 0) | (after >= (self.most if fresh else np.inf))] = np.inf
        level = whole - int(np.argmin(change[::-1]))  # ties go to the fullest window
        new = 2 * counts[size] + 1 if fresh and counts[size] < self.most else np.inf
        if change[level - 1] > new:
            level = 0
        elif change[level - 1] == np.inf:
            # cut where the sum is least then; uncut only onto a level that is full already
            own, after = counts[1:window], np.concatenate((after, counts[1:size]))
            change = np.where(own > 0, 2 * (after - own) + 2, np.inf)
            level = window - 1 - int(np.argmin(change[::-1]))
        held = []
        if level:
            held = self.windows[level].pop()
            counts[level] -= 1
        head, rest = divided(pieces, window - level)
        held.extend(head)
        if level + size >= window:
            yield held
            held = rest
        if held:
            counts[(level + size) % window] += 1
            self.windows[(level + size) % window].append(held)

    def drain(self) -> Iterator[list[Piece]]:
        """What is open is put together by the same rule, the fullest window first, cut where it fits nowhere; one
        window at most stays short."""
        level = self.window - 1
        while level:
            if not self.windows[level]:
                level -= 1
                continue
            pieces = self.windows[level].pop()
            self.counts[level] -= 1
            if not np.any(self.counts[1 : self.window]):
                yield pieces
                return
            yield from self.place(pieces, fresh=False)
            level = self.window - 1


def divided(pieces: list[Piece], size: int) -> tuple[list[Piece], list[Piece]]:
    """The first `size` ids of pieces, and the others."""
    head, rest = [], []
    for row, start, ids in pieces:
        if size > 0:
            head.append((row, start, ids[:size]))
        if size < len(ids):
            rest.append((row, start + max(size, 0), ids[max(size, 0) :]))
        size -= len(ids)
    return head, rest


def pack(docs: DataFrame, tokenizer: str, window: int = 1024, end_id: int = 0) -> DataFrame:
    """Packs every whole text, an id at its end, into sequences of `window` ids.

    Whole windows of a document become sequences of their own, however long it is; what is left of it is placed by
    sum of squares. Every task packs the rows it reads and leaves at most one sequence short, so nothing is
    shuffled and no key can be hot. `tokenizer` is the path of a byte-level BPE file on the executors.

    One row per piece: doc_id, start and length (in ids of its document), ids (little-endian unsigned
    32-bit), doc_tokens, sequence_id, offset (in the sequence). A null or empty text is the end id alone;
    repeated rows are packed as often as they occur; a null doc_id stays null; an empty table gives no
    row. Other columns are not looked at.
    """
    ship(docs.sparkSession)
    key = docs.schema["doc_id"].dataType
    schema = T.StructType(
        [T.StructField("doc_id", key)]
        + [T.StructField(n, T.LongType()) for n in ("start", "length")]
        + [T.StructField("ids", T.BinaryType())]
        + [T.StructField(n, T.LongType()) for n in ("doc_tokens", "sequence_id", "offset")]
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        made = Sequences(TaskContext.get().partitionId() << 33)
        levels, row, rows = Levels(window), 0, {}
        for batch in batches:
            for part in portions(batch):
                names = part.column(0)
                for k, ids in enumerate(ended(*encoder(tokenizer).encode(part.column(1)), end_id)):
                    whole = len(ids) - len(ids) % window
                    rows[row] = [names[k].as_py(), len(ids), len(ids)]
                    for start in range(0, whole, window):
                        made.add([(row, start, ids[start : start + window])], rows)
                    if whole < len(ids):
                        # a copy: a view would keep the ids of the whole batch
                        for full in levels.place([(row, whole, ids[whole:].copy())]):
                            made.add(full, rows)
                    row += 1
                yield made.batch(names.type)
        for full in levels.drain():
            made.add(full, rows)
        if made.columns[0]:
            yield made.batch(names.type)

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(task, schema)


class Sequences:
    """Rows for sequences, numbered from `first` on."""

    def __init__(self, first: int):
        self.next = first
        self.columns: list[list] = [[] for _ in range(7)]

    def add(self, pieces: list[Piece], rows: dict[int, list]) -> None:
        """Appends a sequence; rows has doc_id, number of ids and number of ids not yet in a sequence."""
        offset = 0
        for row, start, ids in pieces:
            document = rows[row]
            values = (document[0], start, len(ids), ids.tobytes(), document[1], self.next, offset)
            for column, value in zip(self.columns, values):
                column.append(value)
            offset += len(ids)
            document[2] -= len(ids)
            if not document[2]:
                del rows[row]
        self.next += 1

    def batch(self, key: pa.DataType) -> pa.RecordBatch:
        long, names = pa.int64(), ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
        kinds = (key, long, long, pa.binary(), long, long, long)
        out = pa.record_batch([pa.array(c, k) for c, k in zip(self.columns, kinds)], names=list(names))
        self.columns = [[] for _ in range(7)]
        return out


def pieces_digest(pieces: DataFrame) -> DataFrame:
    """Packed pieces with the CRC-32 of their ids instead of the ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
