"""Temperature mixing of sources, realised as budgeted block permutations."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.shared import WORD, whole_text
from basketlens.session import staged

#: The exponent is found to this many binary digits, LEVELS of them by each look at the sources.
DIGITS, LEVELS = 12, 4
#: A permutation of a source is cut into so many blocks, by the leading bits of a 60-bit key.
BLOCK_BITS = 12


@dataclass(frozen=True)
class Target:
    """What the mixture has to meet.

    entropy: least entropy of the weights, as a share of what equal weights have. The exponent is the largest
    (nearest to the sources' own shares) that meets it. repeats: no source may be read more often than that;
    where the exponent for the entropy breaks this, the least exponent that keeps to it is taken, or 1 if none does.
    budget: tokens of the mixture as a share of all tokens.
    """

    entropy: float = 0.92
    repeats: float = 4.0
    budget: float = 1.0


TARGET = Target()


def _keyed(docs: DataFrame, seed: int, *keep: str) -> DataFrame:
    """row (the `keep` columns), doc_id, source, tokens (words) and the key that orders the permutation of a source."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    row = F.struct(*[F.col(f"`{c}`") for c in keep])
    return docs.select(
        row.alias("row"),
        F.col("doc_id"),
        F.col("source"),
        F.regexp_count(whole_text(), F.lit(WORD)).cast("long").alias("tokens"),
        F.conv(F.substring(digest, 1, 15), 16, 10).cast("long").alias("key"),
    ).withColumn("block", F.shiftright("key", 60 - BLOCK_BITS).cast("int"))


def exponent(sources: DataFrame, target: Target = TARGET) -> float:
    """The exponent of the sources' token shares that meets the target, a multiple of 2 ** -DIGITS.

    sources: source, tokens; nothing of it but sums for some exponents comes to the driver. Each look decides
    LEVELS steps of the bisection, by the sums at all exponents that these could come to.
    """
    whole, number = sources.where("tokens > 0").agg(F.sum("tokens"), F.count(F.lit(1))).first()
    if not number:
        return 1.0
    shares = sources.where("tokens > 0").select((F.col("tokens") / F.lit(float(whole))).alias("p"))
    wanted = target.entropy * F.log(F.lit(float(number)))

    def sums(alphas: list[float]) -> list:
        p, columns = F.col("p"), []
        for a in alphas:
            z, s = F.sum(F.pow(p, F.lit(a))), F.sum(F.pow(p, F.lit(a)) * F.log(p))
            most = F.max(F.pow(p, F.lit(a - 1.0))) / z * F.lit(target.budget)
            # a little slack: rounding must not decide where the shares meet the target exactly
            columns.append(F.struct((F.log(z) - F.lit(a) * s / z >= wanted - 1e-9), (most <= target.repeats + 1e-9)))
        return list(shares.agg(F.array(*columns).alias("met")).first()[0])

    def search(place: int, rising: bool) -> int | None:
        """The k / 2 ** DIGITS up to which a condition holds (or from which on, if rising); None if it never does."""
        ends = [0, 1 << DIGITS]
        at_low, at_high = (bool(x[place]) for x in sums([0.0, 1.0]))
        best, worst = (at_low, at_high) if rising else (at_high, at_low)
        if best or not worst:
            return (ends[0] if rising else ends[1]) if best else None
        low, high = ends
        while high - low > 1:
            step = max(1, (high - low) >> LEVELS)
            inner = list(range(low + step, high, step))
            met = [bool(x[place]) for x in sums([k / (1 << DIGITS) for k in inner])]
            while high - low > step:
                middle = (low + high) // 2
                holds = met[inner.index(middle)]
                low, high = (low, middle) if holds == rising else (middle, high)
        return high if rising else low

    by_entropy = search(0, rising=False)
    by_repeats = search(1, rising=True)
    found = max(0 if by_entropy is None else by_entropy, (1 << DIGITS) if by_repeats is None else by_repeats)
    return found / (1 << DIGITS)


def _budgets(tempered: DataFrame, alpha: float, whole: int, target: Target) -> DataFrame:
    """Sources (source, source_tokens, weight) with `budget`: whole tokens by largest remainders, so that they add up to
    the target's share of all tokens. A budget that is a number of whole passes but for rounding is these passes."""
    total = tempered.agg(F.coalesce(F.sum("weight"), F.lit(1.0))).first()[0] or 1.0
    tokens = F.col("source_tokens")
    if alpha == 1.0:
        quota = tokens * F.lit(target.budget)
    else:
        quota = F.col("weight") * F.lit(whole * target.budget / total)
    passes = F.round(F.col("quota") / tokens) * tokens
    near = (passes > 0) & (F.abs(F.col("quota") - passes) <= F.lit(1e-9) * passes)
    exact = tempered.withColumn("quota", F.when(tokens > 0, quota).otherwise(0.0))
    exact = exact.withColumn("quota", F.when(tokens > 0, F.when(near, passes).otherwise(F.round("quota", 6))).otherwise(0.0))
    floors = staged(exact.withColumn("floor", F.floor("quota").cast("long")), "floors")
    rest = math.floor(whole * target.budget + 1e-6) - (floors.agg(F.sum("floor")).first()[0] or 0)
    if rest <= 0:
        return floors.withColumn("budget", F.col("floor"))
    ordered = floors.where(tokens > 0).orderBy((F.col("quota") - F.col("floor")).desc(), F.col("source").asc_nulls_first())
    more = ordered.limit(rest).select(F.col("source").alias("more_source"), F.lit(1).cast("long").alias("more"))
    found = floors.join(more, F.col("source").eqNullSafe(F.col("more_source")), "left")
    return found.withColumn("budget", F.col("floor") + F.coalesce("more", F.lit(0)))


def _plan(blocks: DataFrame, target: Target) -> tuple[DataFrame, DataFrame]:
    """Blocks with the tokens of their source before them, and sources with tokens and budget."""
    sources = staged(blocks.groupBy("source").agg(F.sum("tokens").alias("source_tokens")), "sources")
    alpha = exponent(sources.select("source", F.col("source_tokens").alias("tokens")), target)
    whole = sources.agg(F.coalesce(F.sum("source_tokens"), F.lit(0))).first()[0]
    share = F.col("source_tokens") / F.lit(float(whole or 1))
    tempered = sources.withColumn("weight", F.when(F.col("source_tokens") > 0, F.pow(share, F.lit(alpha))).otherwise(0.0))
    planned = staged(_budgets(tempered, alpha, whole, target).select("source", "source_tokens", "budget"), "budgets")
    # at most 2 ** BLOCK_BITS rows of a source
    before = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.select("source", "block", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("block_start"))
    return placed, planned


def _by_source(df: DataFrame) -> DataFrame:
    """df with its source as two columns without nulls: joins by equality leave the partitions that the window needs,
    so whole rows are shuffled once."""
    return df.withColumns({"no_source": F.col("source").isNull(), "source_key": F.coalesce(F.col("source").cast("string"), F.lit(""))})


def _realised(rows: DataFrame, blocks: DataFrame, target: Target) -> DataFrame:
    """rows with the number of times each is read (`times`), its place in the permutation (`start`) and budgets."""
    placed, planned = _plan(blocks, target)
    source = ["no_source", "source_key"]
    joined = _by_source(rows).join(_by_source(placed).drop("source"), [*source, "block"], "left")
    joined = joined.join(_by_source(planned).drop("source"), source, "left")
    order = Window.partitionBy(*source, "block").orderBy("key", F.col("doc_id").asc_nulls_first(), "tokens")
    inside = F.coalesce(F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    full = F.when(F.col("source_tokens") > 0, F.expr("budget div source_tokens")).otherwise(1)
    rest = F.when(F.col("source_tokens") > 0, F.col("budget") % F.col("source_tokens")).otherwise(0)
    started = joined.withColumns({"start": F.col("block_start") + inside, "full": full, "rest": rest})
    last = (F.col("rest") > 0) & (F.col("start") + F.col("tokens") <= F.col("rest"))
    return started.withColumn("times", F.col("full") + F.when(last, 1).otherwise(0))


def _blocks(rows: DataFrame) -> DataFrame:
    return staged(rows.groupBy("source", "block").agg(F.sum("tokens").alias("tokens")), "blocks")


def mixture(docs: DataFrame, target: Target = TARGET, seed: int = 7) -> DataFrame:
    """The mixture: one row for each time a document is read. doc_id, source, tokens, epoch (from 0), position
    (tokens of the source that are read before it) and budget (tokens of the source in the mixture).

    A source is read in one pseudo-random order of its documents, whole as often as its budget allows, then up to
    the budget. Prefix sums go by block of that order, so a hot source is spread over 2 ** BLOCK_BITS groups.
    A null source is a source; a null text has no tokens; sources without tokens are read once; rows alike are read
    next to each other. An empty table gives no row.
    """
    rows = staged(_keyed(docs, seed, "doc_id").drop("row"), "keyed")
    found = _realised(rows, _blocks(rows), target)
    read = found.where("times > 0").select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("n"))
    position = (F.col("n") - 1) * F.col("source_tokens") + F.col("start")
    return read.select("doc_id", "source", "tokens", (F.col("n") - 1).alias("epoch"), position.alias("position"), "budget")


def mixed(docs: DataFrame, target: Target = TARGET, seed: int = 7) -> DataFrame:
    """The rows of docs, all columns, each as often as the mixture reads it."""
    rows = _keyed(docs, seed, *docs.columns)
    found = _realised(rows, _blocks(rows), target).where("times > 0")
    return found.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).select("row.*")
