"""Token ids of whole texts, for use inside tasks."""

from __future__ import annotations

import functools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Different pieces that a worker remembers (some 200 bytes each) before it starts anew.
REMEMBERED = 700_000
#: Characters that are encoded at once.
AT_ONCE = 24_000_000
#: Stands before each space that begins a piece; texts that hold it themselves are encoded directly.
_MARK = "\x01"


class Encoder:
    """Encodes texts with a byte-level BPE tokenizer, each different piece of text only once.

    A piece runs from one space up to the next. The pre-tokenizer always starts a token at a space that
    is followed by something other than white space, so the ids of a text are those of its pieces
    one after the other. Texts in which a space is followed by white space or ends the text, or which hold a special
    token, are encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        # in the byte alphabet of the vocabulary each character stands for one byte
        self.width = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.width[i] = len(token)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = "|".join([r" (?:\s|\z|[\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}])", "\x01", *("\\Q" + t + "\\E" for t in special)])
        self.known: dict[str, bytes] = {}

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (uint32, without nulls), one after the other, and where each text's begin, with the end."""
        texts = texts.cast(pa.large_string())
        direct = pc.match_substring_regex(texts, self.whole).to_numpy(zero_copy_only=False)
        if not direct.any():
            return self._by_pieces(texts)
        found: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        for i in np.flatnonzero(direct):
            found[i] = np.array(self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids, np.uint32)
        rest = np.flatnonzero(~direct)
        ids, bounds = self._by_pieces(texts.take(pa.array(rest)))
        for k, i in enumerate(rest):
            found[i] = ids[bounds[k] : bounds[k + 1]]
        return np.concatenate([np.zeros(0, np.uint32), *found]), np.cumsum([0, *map(len, found)])

    def _by_pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        split = pc.split_pattern(pc.replace_substring(texts, " ", f"{_MARK} "), _MARK)
        pieces = split.flatten().dictionary_encode()
        different = pieces.dictionary.to_pylist()
        self._learn([x for x in different if x not in self.known])
        values = [self.known[x] for x in different]
        ends = np.cumsum([0, *map(len, values)]) // 4
        lists = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(np.frombuffer(b"".join(values), np.uint32)))
        taken = lists.take(pieces.indices)
        starts = taken.offsets.to_numpy()
        bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
        if len(self.known) > REMEMBERED:
            self.known = {}
        return taken.flatten().to_numpy(), starts[bounds] - starts[0]

    def _learn(self, pieces: list[str]) -> None:
        alone = [x for x in pieces if x[:1] != " "]
        for x, found in zip(alone, self.tokenizer.encode_batch_fast(alone, add_special_tokens=False)):
            self.known[x] = np.array(found.ids, np.uint32).tobytes()
        joined = [x for x in pieces if x[:1] == " "]
        groups = [joined[i : i + 2000] for i in range(0, len(joined), 2000)]
        for i in range(0, len(groups), 16):
            batch = groups[i : i + 16]
            for group, found in zip(batch, self.tokenizer.encode_batch_fast(["".join(g) for g in batch], add_special_tokens=False)):
                ids = np.array(found.ids, np.uint32)
                sizes = np.array([len(x.encode()) for x in group])
                cut = np.searchsorted(np.cumsum(self.width[ids]), np.cumsum(sizes)) + 1
                data, begin = ids.tobytes(), 0
                for x, end in zip(group, (cut * 4).tolist()):
                    self.known[x] = data[begin:end]
                    begin = end


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of this worker; what it has learned serves later tasks too."""
    return Encoder(path)


def portions(batch: pa.RecordBatch, column: int = 1, most: int = AT_ONCE) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most `most` bytes of text, or of one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    begin = total = 0
    for i, size in enumerate(sizes.tolist()):
        if total and total + size > most:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield batch.slice(begin)


def ended(ids: np.ndarray, bounds: np.ndarray, end_id: int) -> list[np.ndarray]:
    """The ids of each text with the end id behind them."""
    closed = np.insert(ids, bounds[1:], end_id).astype("<u4")
    bounds = bounds + np.arange(len(bounds))
    return [closed[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
