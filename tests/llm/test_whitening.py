"""Whitening against exact fractions: sums, covariances, projections, odd tables."""

import math
from fractions import Fraction

import numpy as np
import pytest

from basketlens.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, n long, whitened string"


def plain(vectors):
    """n, sums and the covariance of whole-number vectors, by its definition."""
    xs = [[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors]
    n, d = len(xs), len(xs[0])
    sums = [sum(x[i] for x in xs) for i in range(d)]
    mean = [Fraction(s, n) for s in sums]
    cov = [[sum((x[i] - mean[i]) * (x[j] - mean[j]) for x in xs) / n for j in range(d)] for i in range(d)]
    return xs, n, sums, cov


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 0, "w") for i, v in vectors], SCHEMA)


def some(number, dims, seed=5):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(size=(number, dims)) @ rng.normal(size=(dims, dims))
    return [(i, [float(np.float32(x)) for x in row]) for i, row in enumerate(mixed)]


def test_covariance_is_exact(spark):
    vectors = some(60, 5) + [(100, [1e6, -1e6, 3.0, 0.5, 0.25])]  # one far out: squares beyond 64 bits in its rows
    fitted = whitening.fit(frame(spark, vectors).repartition(4))
    _, n, sums, cov = plain([v for _, v in vectors])
    assert (fitted.n, list(fitted.sums)) == (n, sums)
    assert [[Fraction(x, n**3) for x in row] for row in fitted.covariance] == cov


def test_rows(spark, folder):
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    given = {r.vec_id: list(r.embedding) for r in table.collect()}
    found = whitening.by_component(table).collect()
    xs, n, sums, cov = plain(list(given.values()))
    values, vectors = np.linalg.eigh(np.array([[float(x) for x in row] for row in cov]))
    order = np.argsort(-values)[:8]
    assert len(found) == 8 * len(given) and {r.n for r in found} == {n}
    own = dict(zip(given, xs))
    signs = {}
    for r in found:
        x = own[r.vec_id]
        assert r.deviation == sum((n * a - s) ** 2 for a, s in zip(x, sums))
        e = values[order[r.component - 1]]
        assert r.explained == pytest.approx(e / values.sum(), rel=1e-9)
        wanted = float((np.array(x) - np.array(sums) / n) @ vectors[:, order[r.component - 1]] / math.sqrt(e))
        sign = signs.setdefault(r.component, 1 if r.whitened * wanted > 0 else -1)
        assert r.whitened == pytest.approx(sign * wanted, rel=1e-6, abs=1e-6)
    assert len({r.identity_error for r in found}) == 1 and found[0].identity_error < 1e-9


def test_rows_that_go(spark):
    vectors = some(30, 3)
    odd = [(50, None), (51, [1.0, None, 2.0]), (52, [1.0, math.nan, 2.0]), (53, [math.inf, 1.0, 2.0]), (54, [1.0, 2.0]), (55, []), (None, vectors[0][1]), (0, vectors[0][1])]
    found = whitening.by_component(frame(spark, vectors + odd))
    rows = found.collect()
    kept = [v for i, v in vectors] + [vectors[0][1]] * 2
    assert len(rows) == 3 * len(kept) and {r.n for r in rows} == {len(kept)}
    assert {r.vec_id for r in rows} == {i for i, _ in vectors} | {None}
    again = {(r.component, r.whitened, r.deviation) for r in rows if r.vec_id in (0, None)}
    assert len(again) == 3  # rows alike are whitened alike
    assert max(r.identity_error for r in rows) < 1e-9


def test_dimensions_without_variance(spark):
    rows = whitening.by_component(frame(spark, [(i, [float(i), 2.0, -float(i)]) for i in range(10)])).collect()
    assert {(r.component, r.whitened is None) for r in rows} == {(1, False), (2, True), (3, True)}
    assert all(r.explained == pytest.approx(float(r.component == 1)) and r.identity_error < 1e-9 for r in rows)
    one = whitening.by_component(frame(spark, [(1, [1.0, 2.0])])).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.identity_error) for r in one] == [(1, 1, 0, None, None), (2, 1, 0, None, None)]


def test_empty_tables_and_clashing_names(spark):
    empty = frame(spark, [(1, None), (2, [])])
    assert whitening.by_component(empty).count() == 0
    assert whitening.by_component(empty.limit(0)).count() == 0
    docs = frame(spark, some(10, 2))
    out = whitening.whiten(docs, whitening.fit(docs))
    assert out.columns == [*docs.columns, "deviation", "whitened_"]
    assert {len(r.whitened_) for r in out.collect()} == {2} and {r.whitened for r in out.collect()} == {"w"}


def test_large_numbers_are_exact_or_null(spark):
    vectors = [(i, [1e5 * (i % 7), float(i)]) for i in range(50)]
    rows = whitening.by_component(frame(spark, vectors)).collect()
    xs, n, sums, _ = plain([[float(np.float32(c)) for c in v] for _, v in vectors])
    for r in rows:
        exact = sum((n * a - s) ** 2 for a, s in zip(xs[r.vec_id], sums))
        assert r.deviation == (exact if exact < 2**63 else None)
    assert any(r.deviation is None for r in rows) or max(r.deviation for r in rows) > 2**53
