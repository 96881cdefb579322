"""Repeated passages against a plain version that looks at every window."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from basketlens.llm import repeats
from documents import LONG, ODD, frame


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain(rows, size):
    """(doc_id, n_words, n_removed, digest) by the definition."""
    texts = [words_of(t) for _, t in rows]
    number = Counter(tuple(ws[i : i + size]) for ws in texts for i in range(len(ws) - size + 1))
    out = []
    for (name, _), ws in zip(rows, texts):
        covered = set()
        for i in range(len(ws) - size + 1):
            if number[tuple(ws[i : i + size])] > 1:
                covered.update(range(i, i + size))
        kept = " ".join(w for k, w in enumerate(ws) if k not in covered)
        out.append((name, len(ws), len(covered), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def same(df, rows, size):
    got = sorted(map(repr, (tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect())))
    assert got == sorted(map(repr, plain(rows, size)))


def made(seed, few):
    """Documents of few different words (anchors by chance), with passages of about the length, copies and edited copies."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(few)]
    passages = [[rng.choice(vocabulary) for _ in range(n)] for n in (8, 9, 10, 11, 30)]
    rows = []
    for i in range(80):
        ws = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(ws))
            ws[at:at] = rng.choice(passages)
        rows.append((i, " ".join(ws)))
    rows += [(100 + i, rows[7][1]) for i in range(5)]
    edited = rows[8][1].split()
    for i in range(20):
        again = list(edited)
        if again:
            again[rng.randrange(len(again))] = "changed"
        rows.append((200 + i, "\n".join(again)))
    rows += [(300, "a " * 50), (301, "a b " * 30), (302, "a " * 10), (302, "a " * 10), (None, rows[9][1]), (None, None)]
    return rows


@pytest.mark.parametrize(("few", "anchor"), [(3, 2), (40, 3), (500, 10), (500, 1)])
def test_windows_of_ten(spark, few, anchor):
    rows = made(few, few)
    found = repeats.without_repeats(frame(spark, rows).repartition(3), words=10, anchor=anchor)
    same(found, rows, 10)


def test_documents(spark, documents):
    rows = [(r.doc_id + 1000, r.text) for r in documents.select("doc_id", "text").collect()] + ODD + LONG + LONG[:1]
    same(repeats.without_repeats(frame(spark, rows)), rows, 35)


def test_ranges_are_the_longest_ones(spark):
    shared = " ".join(f"s{i}" for i in range(50))
    rows = [(1, f"a b {shared} c d {shared}"), (2, f"x {shared}"), (3, "alone here"), (4, None)]
    found = {r.doc_id: r for r in repeats.repeats(frame(spark, rows)).collect()}
    assert (found[1].begins, found[1].ends, found[1].kept) == ([2, 54], [52, 104], "a b c d")
    assert (found[2].begins, found[2].ends, found[2].kept, found[2].n_removed) == ([1], [51], "x", 50)
    assert (found[3].begins, found[3].kept, found[4].kept, found[4].n_words) == ([], "alone here", "", 0)


def test_every_shared_window_has_its_anchor_in_one_place():
    rng = random.Random(1)
    shared = [f"s{rng.randrange(9)}".encode() for _ in range(35)]
    texts = [b" ".join([f"{k}-{i}".encode() for i in range(k)] + shared + [b"z%d" % k] * k) for k in range(20)]
    found = repeats.anchors(repeats.Hashes(texts))
    bounds = repeats.Hashes(texts).bounds
    places, seeds = set(), set()
    for k in range(20):
        at = np.searchsorted(found[0], bounds[k] + k, "right") - 1
        places.add(int(found[2][at] - bounds[k] - k))
        seeds.add(int(found[3][at]))
    assert len(places) == len(seeds) == 1


def test_empty_table(spark):
    assert repeats.without_repeats(frame(spark, ODD).limit(0)).count() == 0
    same(repeats.without_repeats(frame(spark, ODD)), ODD, 35)
