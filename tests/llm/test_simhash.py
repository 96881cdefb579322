"""SimHash: fingerprints and components against all pairs."""

import random
import re

import pytest
import xxhash

from basketlens.llm import simhash
from basketlens.session import staged
from documents import LONG, ODD, frame


def plain_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values):
    """values: (name, fingerprint) rows; the least name reachable from each row."""
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(values):
        for j in range(i):
            if (a ^ values[j][1]).bit_count() <= 4:
                root[find(i)] = find(j)
    least = {}
    for i, (name, _) in enumerate(values):
        least[find(i)] = min(x for x in (least.get(find(i)), name) if x is not None) if (least.get(find(i)), name) != (None, None) else None
    return [least[find(i)] for i in range(len(values))]


@pytest.mark.parametrize("together", [4096, 2])
def test_near_duplicates(spark, documents, monkeypatch, together):
    monkeypatch.setattr(simhash, "TOGETHER", together)
    rows = [(r.doc_id + 100, r.text) for r in documents.select("doc_id", "text").collect()] + ODD + [(None, ODD[5][1]), (None, "alone and odd")]
    found = {(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(frame(spark, rows)).collect()}
    prints = [(i, plain_fingerprint(t)) for i, t in rows]
    assert found == {(i, f"{p:016x}", c) for (i, p), c in zip(prints, plain_components(prints))}


@pytest.mark.parametrize("together", [4096, 8])
def test_groups_of_near_fingerprints(spark, monkeypatch, together):
    """Chains, stars and a dense group: no link between different fingerprints is lost, whatever way a key takes."""
    monkeypatch.setattr(simhash, "TOGETHER", together)
    rng, values = random.Random(3), set()
    for _ in range(25):
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 12])):
            values.add(x)
            for b in rng.sample(range(64), rng.choice([1, 4, 5])):
                x ^= 1 << b
    dense = rng.getrandbits(64)
    values |= {dense ^ m for m in range(100)}
    rows = sorted((v - (1 << 64) if v >> 63 else v, v) for v in values)
    nodes = spark.createDataFrame([(a,) for a, _ in rows], "fingerprint long")
    edges = staged(simhash.links(nodes), "links")
    assert all((a ^ b) & ((1 << 64) - 1) for a, b in edges.collect())
    labels = {r.node: r.root for r in simhash.components(edges).collect()}
    got = [labels.get(a, a) for a, _ in rows]
    wanted = plain_components(rows)
    assert len(set(zip(got, wanted))) == len(set(got)) == len(set(wanted))


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(1000, 1001), (7, 7)], "a long, b long")
    labels = {r.node: r.root for r in simhash.components(edges).collect()}
    assert len({labels[i] for i in range(41)}) == 1 and labels[1000] == labels[1001] != labels[0]


def test_one_of_each_group_stays(spark):
    rows = [*ODD, *ODD, (None, ODD[5][1]), (None, "alone and odd"), (3, "Another text altogether here")]
    docs = frame(spark, rows)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    values = [(i, plain_fingerprint(t)) for i, t in rows]
    numbered = plain_components([(k, p) for k, (_, p) in enumerate(values)])
    assert kept.count() == len(set(numbered))
    assert {r.doc_id for r in kept.collect()} <= {i for i, _ in rows}


def test_long_and_empty(spark):
    docs = frame(spark, LONG)
    assert {r.doc_id: int(r.fingerprint, 16) for r in simhash.near_duplicates(docs).collect()} == {i: plain_fingerprint(t) for i, t in LONG}
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.drop_near_duplicates(docs.limit(0)).count() == 0
