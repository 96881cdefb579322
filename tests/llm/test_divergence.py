"""Quality rules: counts against plain ones, verdicts by divergence and length."""

import math
import random
import re
from collections import Counter

import pytest

from basketlens.llm import divergence
from documents import LONG, ODD, frame


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    number, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if number[w] > 1:
            covered.update(range(i, i + 8))
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    counts = (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered))
    return *counts, len(words) < 20 or 100 * len(covered) > 30 * len(words)


def plain_distance(own, reference):
    if not sum(own) or not sum(reference):
        return 0.0
    p, q = ([x / sum(v) for x in v] for v in (own, reference))
    total = 0.0
    for a, b in zip(p, q):
        m = (a + b) / 2
        total += sum(x * math.log2(x / m) for x in (a, b) if x) / 2
    return math.sqrt(max(0.0, total))


def plain_histograms(text, lang):
    """Bytes by class of their character, and words by place in the list of the language."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    classes = [len(re.findall(c, text)) for c in divergence.CLASSES]
    spaces = len(text) - sum(map(len, words))
    chars = [*classes, spaces, len(text.encode()) - len(text), len(text) - spaces - sum(classes)]
    listed = divergence.COMMON.get(lang, ("",) * 10)
    bare = [re.sub(r"[.,;:!?'\"()\-]", "", w.lower()) for w in words if len(w) <= 7]
    hits = [bare.count(w) if w else 0 for w in listed]
    return chars, [len(words) - sum(hits), *hits]


def plain_kept(rows):
    """The ids of (doc_id, text, lang) rows that the quality rules keep."""
    limits, references = divergence.LIMITS, {}
    for _, text, lang in rows:
        own = plain_histograms(text, lang)
        references[lang] = [[a + b for a, b in zip(x, y)] for x, y in zip(references.get(lang, ([0] * 9, [0] * 11)), own)]
    kept = []
    for name, text, lang in rows:
        chars, words = plain_histograms(text, lang)
        far = len(text or "") >= limits.chars_least and plain_distance(chars, references[lang][0]) > limits.char_divergence
        alone = plain_distance([1] + [0] * 10, references[lang][1])
        odd = plain(text)[0] >= limits.words_least and plain_distance(words, references[lang][1]) > limits.word_share * alone
        if not (plain(text)[-1] or far or odd):
            kept.append(name)
    return kept


REPEATS = [
    (30, " ".join(map(str, range(40))) + " x " + " ".join(map(str, range(10, 25)))),
    (31, "a b c d e f g h i " * 3),
    (32, "a " * 8),
    (33, "a " * 9),
    (34, "l\nl\n\nm\n \nl # * $ % & | < >"),
]


def test_counts(spark, documents):
    rows = [(r.doc_id + 1000, r.text) for r in documents.select("doc_id", "text").collect()] + ODD + LONG + REPEATS
    found = divergence.quality(frame(spark, rows)).collect()
    texts = dict(rows)
    assert len(found) == len(rows)
    for r in found:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == plain(texts[r.doc_id]), r.doc_id
        assert not (r.base_failed and r.kept)


def test_distance_is_that_of_jensen_and_shannon(spark):
    row = spark.createDataFrame([([1, 3, 0], [2, 2, 4], [0, 0, 0])], "a array<int>, b array<int>, c array<int>")
    got = row.select(*[divergence._distance(row[x], row[y]) for x, y in (("a", "b"), ("a", "a"), ("a", "c"))]).first()
    p, q = (0.25, 0.75, 0.0), (0.25, 0.25, 0.5)
    m = [(x + y) / 2 for x, y in zip(p, q)]
    wanted = math.sqrt(sum((x * math.log2(x / k) if x else 0) / 2 for v in (p, q) for x, k in zip(v, m)))
    assert got[0] == pytest.approx(wanted) and got[1] == pytest.approx(0) and got[2] == 0


def test_far_documents_go_if_long_enough(spark):
    clean = [(i, " ".join(f"the word{i}x of a house{k} and the tree{k} is in it" for k in range(12))) for i in range(30)]
    odd = [(100, " ".join(f"%$#{i}&&&***|<>" for i in range(60))), (101, "%$# &&& ***")]
    docs = frame(spark, clean + odd)
    kept = {r.doc_id: (r.kept, r.base_failed) for r in divergence.quality(docs).collect()}
    assert all(kept[i] == (True, False) for i, _ in clean)
    assert kept[100] == (False, False) and kept[101] == (False, True)
    out = divergence.drop_low_quality(docs)
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == {i for i, _ in clean}


def test_wrong_languages_and_lists_of_words_go(spark):
    r = random.Random(3)

    def text(lang, start):
        listed = [w for k, w in enumerate(divergence.COMMON[lang]) for _ in range(10 - k)]
        words = [r.choice(listed) if r.random() < 0.3 else f"word{start}x{k}" for k in range(150)]
        return " ".join(w.capitalize() + "," if k % 5 == 0 else w for k, w in enumerate(words))

    clean = [(i, text("en", i)) for i in range(40)]
    other = [(100, text("de", 100)), (101, text("es", 101))]
    lists = [(200, "\n".join(f"entry{k}x" for k in range(150))), (201, ", ".join(f"Term{k}y" for k in range(80)))]
    short = [(300, " ".join(f"thing{k}z" for k in range(30)))]
    rows = [(i, t, "en") for i, t in clean + other + lists + short]
    found = {x.doc_id: (x.kept, x.base_failed) for x in divergence.quality(frame(spark, clean + other + lists + short, lang="en")).collect()}
    assert {i for i, _ in other + lists} == {i for i, (kept, base) in found.items() if not kept and not base}
    assert sorted(i for i, (kept, _) in found.items() if kept) == sorted(plain_kept(rows))


def test_null_and_unknown_languages_and_empty_table(spark):
    docs = frame(spark, ODD, lang=None).union(frame(spark, [(50, ODD[5][1])], lang="xx"))
    assert divergence.quality(docs).count() == len(ODD) + 1
    assert divergence.quality(docs.limit(0)).count() == 0
    assert divergence.drop_low_quality(docs.limit(0)).count() == 0


def test_verdicts_of_a_table(spark, documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text", "lang").collect()]
    found = [r.doc_id for r in divergence.quality(documents).where("kept").collect()]
    assert sorted(found) == sorted(plain_kept(rows))
