"""Stupid backoff against counts of n-grams in dictionaries."""

import math
import re
from collections import Counter

import pytest

from basketlens.llm import backoff_lm
from documents import LONG, ODD, frame


def plain_scores(texts, order=3, backoff=0.4):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    grams = [Counter(tuple(w[i - n + 1 : i + 1]) for n in range(1, order + 1) for i in range(n - 1, len(w))) for w in words]
    corpus, total = Counter(), sum(map(len, words))
    for g in grams:
        corpus.update(g)
    found = []
    for w, own in zip(words, grams):
        score = 0.0
        for i in range(len(w)):
            factor = 1.0
            for n in range(min(order, i + 1), 0, -1):
                gram = tuple(w[i - n + 1 : i + 1])
                count = corpus[gram] - own[gram]
                if n == 1:
                    score += math.log(factor * max(count, 1) / (total - len(w) + 1))
                elif count:
                    score += math.log(factor * count / (corpus[gram[:-1]] - own[gram[:-1]]))
                    break
                else:
                    factor *= backoff
        found.append((len(w), score))
    return found


@pytest.mark.parametrize("order", [1, 2, 3])
@pytest.mark.parametrize("chars, grams", [(8_000_000, 4_000_000), (3000, 500)])
def test_scores(spark, documents, monkeypatch, chars, grams, order):
    monkeypatch.setattr(backoff_lm, "BLOCK_CHARS", chars)
    monkeypatch.setattr(backoff_lm, "RANGE_GRAMS", grams)
    rows = [(r.doc_id + 1000, r.text) for r in documents.select("doc_id", "text").limit(80).collect()] + ODD + LONG[:1] + [(None, "the cat")]
    found = {r.doc_id: r for r in backoff_lm.scores(frame(spark, rows), order).collect()}
    assert len(found) == len(rows)
    for (i, _), (n, score) in zip(rows, plain_scores([t for _, t in rows], order)):
        assert found[i].n_words == n
        assert found[i].log_score == pytest.approx(score, rel=1e-9)
        assert found[i].mean_log_score == (pytest.approx(score / n, rel=1e-9) if n else None)


def test_repeated_rows_and_empty_table(spark):
    docs = frame(spark, [(1, "a b c")] * 3)
    assert [round(r.log_score, 6) for r in backoff_lm.scores(docs).collect()] == [round(plain_scores(["a b c"] * 3)[0][1], 6)] * 3
    assert backoff_lm.scores(docs.limit(0)).count() == 0


def test_blocks_leave_no_table_and_are_not_shuffled(spark, documents):
    found = backoff_lm.scores(documents.select("doc_id", "text").limit(40))
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("blocks_")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan
    assert found.count() == 40
