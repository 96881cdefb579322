"""Wavelet shards: exact round trip, access, counting and lookup."""

import numpy as np
import pytest

from basketlens.llm import wavelet
from basketlens.llm.queries import TOKENIZER
from basketlens.llm.tokens import Encoder
from basketlens.session import scratch_path
from documents import LONG, ODD, frame


@pytest.mark.parametrize("n", [0, 1, 4096, 65536, 70001])
@pytest.mark.parametrize("top", [1, 300, 50256, 1 << 20])
def test_shard(n, top):
    rng = np.random.default_rng(n + top)
    ids = np.minimum(rng.zipf(1.3, n), top).astype(np.uint32)
    shard = wavelet.Shard(wavelet.encode(ids, np.array([3]), np.array([False]), np.array([n])))
    assert (shard.decode() == ids).all() and shard.lengths.tolist() == [n] and shard.doc_ids.to_pylist() == [3]
    for i in {0, n // 2, n - 1} if n else ():
        token = int(ids[i])
        assert shard.access(i) == token
        assert shard.locate(token, int((ids[:i] == token).sum())) == i
        assert shard.count(token) == (ids == token).sum()
        assert shard.count(token, i // 2, i + 1) == (ids[i // 2 : i + 1] == token).sum()
    assert shard.count(top + 1) == 0
    with pytest.raises(IndexError):
        shard.access(n)
    with pytest.raises(IndexError):
        shard.locate(top + 1, 0)


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        wavelet.Shard(b"something else")


@pytest.mark.parametrize("shard_ids", [50, 1 << 22])
def test_round_trip(spark, shard_ids):
    encoder = Encoder(TOKENIZER)
    docs = frame(spark, [*LONG, *ODD, (None, "no id"), (3, "Another text")]).repartition(3)
    folder = scratch_path(spark, "shards")
    manifest = wavelet.write_shards(docs, folder, TOKENIZER, shard_ids=shard_ids)
    found = wavelet.read_documents(spark, folder).orderBy("start").collect()
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    place = 0
    for row, doc in zip(rows, found, strict=True):
        expected = [*encoder.tokenizer.encode(row.text or "", add_special_tokens=False).ids, 0]
        assert (doc.doc_id, doc.start, doc.n_tokens) == (row.doc_id, place, len(expected))
        assert np.frombuffer(doc.ids, "<u4").tolist() == expected
        place += len(expected)
    assert manifest.agg({"n_tokens": "sum"}).first()[0] == place
    assert manifest.agg({"n_docs": "sum"}).first()[0] == len(rows)


def test_empty_table(spark):
    folder = scratch_path(spark, "shards")
    wavelet.write_shards(frame(spark, ODD).limit(0), folder, TOKENIZER)
    assert wavelet.read_documents(spark, folder).count() == 0


def test_a_repeated_task_replaces_its_file(spark, tmp_path):
    for data in (b"first", b"second"):
        wavelet._store(str(tmp_path), "x.wvm", data)
    assert [p.read_bytes() for p in tmp_path.iterdir()] == [b"second"]
