"""Packing: every id in exactly one piece, sequences without gaps, little padding."""

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from basketlens.llm import packing
from basketlens.llm.queries import TOKENIZER
from basketlens.llm.tokens import Encoder
from documents import LONG, ODD, frame


@pytest.fixture(scope="module")
def encoder():
    return Encoder(TOKENIZER)


def ids_of(encoder, text):
    return [*encoder.tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def checked(encoder, texts, pieces, window):
    """texts by doc_id; gives the ids and the number of sequences."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert set(by_doc) == set(texts)
    for doc_id, own in by_doc.items():
        expected, place = ids_of(encoder, texts[doc_id]), 0
        for p in sorted(own, key=lambda p: p.start):
            assert p.start == place and p.length > 0 and p.doc_tokens == len(expected)
            assert np.frombuffer(p.ids, "<u4").tolist() == expected[p.start : p.start + p.length]
            place += p.length
        assert place == len(expected)
    for own in by_sequence.values():
        place = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == place
            place += p.length
        assert place <= window
    return sum(p.length for p in pieces), len(by_sequence)


@pytest.mark.parametrize("window", [16, 1024])
def test_pieces_cover_documents(spark, encoder, window):
    docs = frame(spark, [*ODD, *LONG])
    pieces = packing.pack(docs, TOKENIZER, window).collect()
    checked(encoder, {r.doc_id: r.text for r in docs.collect()}, pieces, window)


def test_given_documents(spark, encoder, documents):
    pieces = packing.pack(documents, TOKENIZER).collect()
    ids, sequences = checked(encoder, {r.doc_id: r.text for r in documents.collect()}, pieces, 1024)
    parts = documents.rdd.getNumPartitions()
    assert sequences * 1024 - ids <= 1024 * parts


def test_repeated_rows_and_null_ids(spark):
    docs = frame(spark, [(None, "a b c"), (1, "a b c"), (1, "a b c")])
    pieces = packing.pack(docs, TOKENIZER, 8).collect()
    assert sum(p.length for p in pieces) == sum(p.doc_tokens for p in pieces if p.start == 0) == 12
    assert packing.pack(docs.limit(0), TOKENIZER).count() == 0


def test_digest_is_the_checksum_of_the_ids(spark):
    pieces = packing.pack(frame(spark, ODD), TOKENIZER, 8)
    assert all(zlib.crc32(r.ids) == r.crc for r in pieces.select("ids", F.crc32("ids").alias("crc")).collect())
    assert "ids" not in packing.pieces_digest(pieces).columns


def piece(row, size):
    return [(row, 0, np.arange(size, dtype=np.uint32))]


def laid(levels, sizes):
    """All windows that come of pieces of these sizes, those of the last short one included; every id once, in order."""
    full = [w for row, size in enumerate(sizes) for w in levels.place(piece(row, size))]
    online = len(full)
    full += levels.drain()
    got = defaultdict(list)
    for w in full:
        for row, start, ids in w:
            assert len(ids)
            got[row].append((start, ids))
    for row, size in enumerate(sizes):
        found = sorted(got[row], key=lambda p: p[0])
        assert [start for start, _ in found] == [int(ids[0]) for _, ids in found]
        assert np.concatenate([ids for _, ids in found]).tolist() == list(range(size))
    filled = [sum(len(ids) for _, _, ids in w) for w in full]
    assert all(n == levels.window for n in filled[:-1]) and all(n <= levels.window for n in filled)
    assert not levels.counts[1 : levels.window].any()
    return full, online, sum(len(p) > 1 for p in got.values())


def test_level_with_least_squares_is_taken():
    levels = packing.Levels(10)
    for size in (4, 4, 4):
        assert list(levels.place(piece(0, size))) == []
    # the second piece of 4 opened no third kind of level: 4 + 4 leaves one window on 4 and one on 8
    assert levels.counts[4] == 1 and levels.counts[8] == 1
    full = list(levels.place(piece(1, 6)))
    assert [[len(ids) for _, _, ids in w] for w in full] == [[4, 6]]


def squares(levels):
    return sum(n * n for n in levels.counts[1 : levels.window])


def test_every_step_is_the_best_of_all_steps():
    """Against all placements, tried one by one: uncut ones on levels below the limit first, then any."""
    r = np.random.default_rng(5)
    levels = packing.Levels(12, most=2)
    for row, size in enumerate(r.choice([1, 5, 7, 8, 11], 3000).tolist()):
        before = levels.counts.copy()
        uncut, cut = [], []
        for level in [0, *np.flatnonzero(before[:12] > 0).tolist()]:
            after = before.copy()
            after[level] -= level > 0
            to = (level + size) % 12
            after[to] += to > 0
            allowed = level + size == 12 or (level + size < 12 and before[to] < 2)
            cost = sum(n * n for n in after[1:12])
            (uncut if allowed else cut).append(cost)
        list(levels.place(piece(row, size)))
        assert squares(levels) == min(uncut or cut)


@pytest.mark.parametrize("most", [1, 4])
@pytest.mark.parametrize("sizes", [[600] * 3000, [1023] * 800, [512] * 999, [1] * 3000, [5], []])
def test_equal_lengths(sizes, most):
    levels = packing.Levels(1024, most)
    for row, size in enumerate(sizes):
        list(levels.place(piece(row, size)))
        assert levels.counts[1:1024].max() <= most
    full, _, _ = laid(packing.Levels(1024, most), sizes)
    assert len(full) == -(-sum(sizes) // 1024)


def test_few_documents_are_cut():
    r = np.random.default_rng(11)
    sizes = np.exp(r.normal(5.5, 1.0, 10_000)).astype(int) % 1023 + 1
    full, online, cut = laid(packing.Levels(1024), sizes.tolist())
    assert online > 0.8 * len(full) and cut < 0.05 * len(sizes)
    # a task of 500 documents ends with relatively more open windows
    _, _, cut = laid(packing.Levels(1024), sizes[:500].tolist())
    assert cut < 0.2 * 500


def test_encoder_gives_the_ids_of_the_library(encoder):
    texts = ["", " ", "a  b", "a \n b ", "x\x01 y", "hi <|endoftext|> x", "don't  stop\n\n now", "q 　w", "tab\t x\ty", "中文 5,7!!"]
    for known in ([], texts):
        ids, bounds = encoder.encode(pa.array([*texts, *known]))
        for i, text in enumerate(texts):
            assert ids[bounds[i] : bounds[i + 1]].tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
