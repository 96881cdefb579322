"""Weighted sampling: edits, equal texts, and the collision rate against the generalised Jaccard similarity."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from basketlens.llm import weighted_sampling
from documents import LONG, ODD, frame


def similarity(a, b):
    x, y = Counter(a.encode().split()), Counter(b.encode().split())
    return sum((x & y).values()) / max(1, sum((x | y).values()))


def followed(rows):
    """(doc_id, text, text of the next document)."""
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    return [(i, t, ordered[(k + 1) % len(ordered)][1]) for k, (i, t) in enumerate(ordered)]


def hashed(*parts):
    """XXH64 of numbers one after the other, each seeded by the hash before; 32-bit numbers as (number, 4)."""
    seed = 42
    for number, size in parts:
        seed = xxhash.xxh64_intdigest(number.to_bytes(size, "little", signed=number < 0), seed)
    return seed


def plain_fingerprint(text):
    """Consistent weighted sampling by its formula: for each sample the term of least ln a = ln c - r (t - beta + 1)."""
    counts = Counter(w.decode() for w in text.encode().split())
    out = []
    for k in range(weighted_sampling.SAMPLES):
        best = None
        for word, weight in counts.items():
            term = xxhash.xxh64_intdigest(word.encode(), 42)
            u, v = hashed((term, 8), (k, 4), (0, 4)), hashed((term, 8), (k, 4), (1, 4))
            cut = [((x >> shift & (1 << size) - 1) + 0.5) / (1 << size) for x, shift, size in ((u, 0, 21), (u, 21, 21), (u, 42, 22), (v, 0, 21), (v, 21, 21))]
            r, beta, c = -math.log(cut[0] * cut[1]), cut[2], -math.log(cut[3] * cut[4])
            t = math.floor(math.log(weight) / r + beta)
            rank = int((math.log(c) - r * (t - beta + 1) + 128) * (1 << 24))
            name = hashed((term, 8), (t, 8), (k, 4)) & 0x7FFFFFFF
            best = min(best or (rank, name), (rank, name))
        out.append(f"{best[1]:08x}" if best else "ffffffff")
    return "".join(out)


def test_fingerprints_by_the_formula(spark, documents):
    rows = [(r.doc_id + 100, r.text[:400]) for r in documents.select("doc_id", "text").limit(25).collect()] + ODD
    rows += [(90, "one " * 400 + "two"), (91, "one two"), (92, "two " * 7 + "one one")]
    found = {r.doc_id: r for r in weighted_sampling.fingerprints(frame(spark, rows)).collect()}
    for i, text, after in followed(rows):
        half = len(text) // 2
        own, edited, following = map(plain_fingerprint, (text, text[: len(text) - half] + after[:half], after))
        assert (found[i].fingerprint, found[i].edited_fingerprint) == (own, edited)
        for near, other in ((found[i].near_edited, edited), (found[i].near_next, following)):
            assert near == np.mean([own[p : p + 8] == other[p : p + 8] for p in range(0, len(own), 8)])


@pytest.mark.parametrize("bucket, ranges", [(3, 1024), (2, 4), (2000, 1024)])
def test_fingerprints(spark, documents, monkeypatch, bucket, ranges):
    monkeypatch.setattr(weighted_sampling, "BUCKET_ROWS", bucket)
    monkeypatch.setattr(weighted_sampling, "RANGES", ranges)
    rows = [(r.doc_id + 100, r.text) for r in documents.select("doc_id", "text").limit(60).collect()] + ODD + LONG + [(None, "no id at all")]
    found = {r.doc_id: r for r in weighted_sampling.fingerprints(frame(spark, rows)).collect()}
    assert len(found) == len(rows)
    prints, errors = {}, []
    for i, text, after in followed(rows):
        r, half = found[i], len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(text if text.split() else None, r.fingerprint) == r.fingerprint
        assert len(r.fingerprint) == 8 * weighted_sampling.SAMPLES
        if text.split() and after.split():
            errors += [r.near_edited - similarity(text, edited), r.near_next - similarity(text, after)]
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.12


def test_ties_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(weighted_sampling, "BUCKET_ROWS", 1)
    rows = [(1, "b c"), (1, "a c"), (1, "a c"), (2, "x"), (2, "x")]
    got = sorted((r.doc_id, r.edited_sha256) for r in weighted_sampling.fingerprints(frame(spark, rows)).collect())
    wanted = []
    for i, text, after in followed(rows):
        half = len(text) // 2
        wanted.append((i, hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()))
    assert got == sorted(wanted)


def test_one_row_and_none(spark):
    row = weighted_sampling.fingerprints(frame(spark, [(1, "a b c d e f")])).first()
    assert row.near_next == 1.0 and 0 < row.near_edited <= 1
    empty = weighted_sampling.fingerprints(frame(spark, [(1, ""), (2, None), (3, "x")])).collect()
    assert {r.doc_id: r.near_next for r in empty} == {3: 0.0, 2: 1.0, 1: 0.0}
    assert weighted_sampling.fingerprints(frame(spark, ODD).limit(0)).count() == 0


def test_collisions_follow_weights(spark):
    """Many samples of two weighted sets: the share in common nears the sum of lesser by that of larger weights."""
    pairs = [(i, " ".join([f"a{i}"] * 6 + [f"b{i}"] * 2), " ".join([f"a{i}"] * 3 + [f"b{i}"] * 4)) for i in range(150)]
    texts = spark.createDataFrame(pairs, "k int, one string, two string")
    found = weighted_sampling.signatures(texts, "k", sides=("one", "two"))
    near = found.select(weighted_sampling.likeness(found["one_signature"], found["two_signature"])).collect()
    assert np.mean([r[0] for r in near]) == pytest.approx(5 / 10, abs=0.03)


def test_buckets_keep_the_order_of_ids(spark, monkeypatch):
    """Uneven ids, up to the ends of 64 bits, in few ranges of many buckets."""
    monkeypatch.setattr(weighted_sampling, "BUCKET_ROWS", 5)
    monkeypatch.setattr(weighted_sampling, "RANGES", 8)
    draw = random.Random(3)
    ids = [draw.randrange(10 ** draw.randrange(1, 18)) for _ in range(400)] + [-(2**63), 2**63 - 1, 0, 0, 0]
    frame_ = spark.createDataFrame([(i,) for i in ids] + [(None,)], "doc_id long")
    bounds, slices = weighted_sampling._bounds(frame_)
    assert len(bounds) <= 9 and slices > 1
    rows = frame_.withColumn("bucket", weighted_sampling._bucket(bounds, slices)).collect()
    placed = [r.bucket for r in sorted(rows, key=lambda r: -1 if r.doc_id is None else r.doc_id + 2**63)]
    assert placed[0] == -1 and placed[1:] == sorted(placed[1:]) and len(set(placed)) > 8
    seen = spark.createDataFrame([(b,) for b in set(placed)], "bucket long")
    links = {r.bucket: r.next_bucket for r in weighted_sampling._linked(seen, slices).collect()}
    down = sorted(set(placed), reverse=True)
    assert links == dict(zip(down, down[1:] + down[:1]))


def test_no_text_goes_through_a_window_of_all_rows(spark, documents, monkeypatch):
    """Windows without a partition hold numbers of ranges only."""
    seen = spark.range(10).select(weighted_sampling.F.col("id").alias("bucket"))
    plan = weighted_sampling._linked(seen, 3)
    assert [t for _, t in plan.dtypes] == ["bigint"] * len(plan.columns)
    found = weighted_sampling.fingerprints(documents.select("doc_id", "text").limit(50))
    text = found._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in text.splitlines() if "Window [" in line]
    assert windows and all("bucket" in line for line in windows)
