"""Mixing: the exponent against a plain search, budgets, permutations."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest

from basketlens.llm import mixing
from documents import ODD, frame


def entropy(tokens, a):
    whole = sum(tokens)
    powers = [(t / whole) ** a for t in tokens]
    weights = [x / sum(powers) for x in powers]
    return -sum(w * math.log(w) for w in weights) / math.log(len(tokens))


def repeats(tokens, a, budget=1.0):
    whole = sum(tokens)
    powers = [(t / whole) ** a for t in tokens]
    return max(budget * whole * x / sum(powers) / t for x, t in zip(powers, tokens))


STEPS = 1 << mixing.DIGITS


def plain_times(rows, target=mixing.TARGET, seed=7):
    """How often each of the (doc_id, text, source) rows is read: by exponent, budgets and one order a source."""
    sources = defaultdict(list)
    for name, text, source in rows:
        key = int(hashlib.md5(f"{seed}:{'' if name is None else name}".encode()).hexdigest()[:15], 16)
        sources[source].append((key, name, len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))))
    tokens = {s: sum(x[2] for x in own) for s, own in sources.items()}
    sizes = [n for n in tokens.values() if n]
    grid = [k / STEPS for k in range(STEPS + 1)]
    by_entropy = max((a for a in grid if len(sizes) < 2 or entropy(sizes, a) >= target.entropy - 1e-9), default=0.0)
    by_repeats = min((a for a in grid if repeats(sizes, a, target.budget) <= target.repeats + 1e-9), default=1.0)
    alpha, whole = max(by_entropy, by_repeats), sum(sizes)
    powers = {s: (n / whole) ** alpha for s, n in tokens.items() if n}
    quota = {s: tokens[s] * target.budget if alpha == 1 else whole * target.budget * p / sum(powers.values()) for s, p in powers.items()}
    for s, q in quota.items():
        passes = round(q / tokens[s]) * tokens[s]
        quota[s] = passes if passes and abs(q - passes) <= 1e-9 * passes else round(q, 6)
    budgets = {s: math.floor(q) for s, q in quota.items()}
    left = math.floor(whole * target.budget + 1e-6) - sum(budgets.values())
    for s in sorted(quota, key=lambda s: (budgets[s] - quota[s], s is not None, s))[: max(0, left)]:
        budgets[s] += 1
    times = Counter()
    for source, own in sources.items():
        n, at = tokens[source], 0
        for _, name, size in sorted(own, key=lambda x: (x[0], x[1] is not None, x[1], x[2])):
            full, rest = divmod(budgets[source], n) if n else (1, 0)
            times[name] += full + (rest > 0 and at + size <= rest)
            at += size
    return +times


@pytest.mark.parametrize("tokens", [[1000, 10, 10, 10], [5, 5, 5], [100, 50, 25, 12, 6, 3, 1]])
@pytest.mark.parametrize(("wanted", "limit"), [(0.5, 1e9), (0.7, 1e9), (0.92, 1e9), (1.0, 1.5), (0.92, 0.5), (0.92, 1.0), (0.7, 4.0)])
def test_exponent(spark, tokens, wanted, limit):
    sources = spark.createDataFrame(list(enumerate(tokens)) + [(99, 0)], "source int, tokens long")
    got = mixing.exponent(sources, mixing.Target(entropy=wanted, repeats=limit))
    grid = [k / STEPS for k in range(STEPS + 1)]
    by_entropy = max((a for a in grid if entropy(tokens, a) >= wanted - 1e-9), default=0.0)
    by_repeats = min((a for a in grid if repeats(tokens, a) <= limit + 1e-9), default=1.0)
    assert got == max(by_entropy, by_repeats)


def test_mixture(spark, documents):
    target = mixing.Target(entropy=0.99, repeats=3.0, budget=1.3)
    rows = mixing.mixture(documents, target).collect()
    by_source = defaultdict(list)
    for r in rows:
        by_source[r.source].append(r)
    whole, budgets = 0, {}
    for source, own in by_source.items():
        own.sort(key=lambda r: r.position)
        first = [r for r in own if r.epoch == 0]
        assert sum(r.tokens for r in own) <= own[0].budget or own[0].budget == 0
        place = 0
        for r in own:
            assert r.position == place
            place += r.tokens
        # every pass reads one and the same permutation, the last one up to the budget
        order = [r.doc_id for r in first]
        for epoch in range(1, max(r.epoch for r in own) + 1):
            again = [r.doc_id for r in own if r.epoch == epoch]
            assert again == order[: len(again)]
            assert len(again) == len(order) or epoch == max(r.epoch for r in own)
        budgets[source] = own[0].budget
    tokens = {r.source: r.n for r in mixing._keyed(documents, 7, "doc_id").groupBy("source").agg({"tokens": "sum"}).withColumnRenamed("sum(tokens)", "n").collect()}
    whole = sum(tokens.values())
    assert sum(budgets.values()) <= whole * target.budget
    assert sum(budgets.values()) >= whole * target.budget * 0.999 - len(budgets)
    assert all(budgets[s] <= target.repeats * n + 1 for s, n in tokens.items())


def test_mixed_rows(spark):
    docs = frame(spark, ODD, source="big").union(frame(spark, [(50, "small one"), (51, None)], source=None)).union(frame(spark, [(60, " ")], source="none"))
    out = mixing.mixed(docs, mixing.Target(entropy=0.9, repeats=100.0))
    assert out.columns == docs.columns
    times = {(r.source, r.doc_id): r["count"] for r in out.groupBy("source", "doc_id").count().collect()}
    wanted = {(r.source, r.doc_id): r["count"] for r in mixing.mixture(docs, mixing.Target(entropy=0.9, repeats=100.0)).groupBy("source", "doc_id").count().collect()}
    assert times == wanted and times[("none", 60)] == 1 and times[(None, 50)] > 1
    assert mixing.mixture(docs.limit(0)).count() == 0 and mixing.mixed(docs.limit(0)).count() == 0


def test_plan_has_no_python(spark, documents):
    plan = mixing.mixed(documents)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "InPandas", "InArrow", "CartesianProduct"))


def test_nothing_goes_where_the_target_is_met_at_exponent_one(spark):
    """Sources of odd sizes, many of one document, one of them with a share under 5e-10 of a huge source."""
    rows = [(f"s{k}", k % 7 + 1) for k in range(40)] + [("t", 3)] * 11
    docs = None
    for i, (source, n) in enumerate(rows):
        one = [(i, " ".join(["w"] * n), "en", source)]
        docs = one if docs is None else docs + one
    frame_ = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    target = mixing.Target(entropy=0.5)
    found = mixing.mixture(frame_, target).collect()
    assert sorted(r.doc_id for r in found) == list(range(len(rows)))
    sizes = defaultdict(int)
    for source, n in rows:
        sizes[source] += n
    assert {r.source: r.budget for r in found} == sizes
    sources = spark.createDataFrame([("huge", 3_000_000_000, 1.0), ("small", 1, 1 / 3_000_000_000)], "source string, source_tokens long, weight double")
    got = {r.source: r.budget for r in mixing._budgets(sources, 1.0, 3_000_000_001, mixing.Target()).collect()}
    assert got == {"huge": 3_000_000_000, "small": 1}


def test_budgets_add_up_by_largest_remainders(spark):
    tokens = {"a": 1000, "b": 10, "c": 10, None: 7}
    whole, alpha = sum(tokens.values()), 0.3
    powers = {s: (n / whole) ** alpha for s, n in tokens.items()}
    quota = {s: whole * p / sum(powers.values()) for s, p in powers.items()}
    wanted = {s: math.floor(q) for s, q in quota.items()}
    for s in sorted(quota, key=lambda s: wanted[s] - quota[s])[: whole - sum(wanted.values())]:
        wanted[s] += 1
    sources = spark.createDataFrame([(s, n, powers[s]) for s, n in tokens.items()], "source string, source_tokens long, weight double")
    got = {r.source: r.budget for r in mixing._budgets(sources, alpha, whole, mixing.Target()).collect()}
    assert got == wanted and sum(got.values()) == whole


@pytest.mark.parametrize("target", [mixing.TARGET, mixing.Target(entropy=0.99, repeats=3.0, budget=1.3), mixing.Target(budget=0.5)])
def test_times_of_a_table(spark, documents, target):
    rows = [tuple(r) for r in documents.select("doc_id", "text", "source").collect()]
    found = Counter(r.doc_id for r in mixing.mixture(documents, target).collect())
    assert found == plain_times(rows, target)
