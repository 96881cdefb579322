"""Consistent weighted sampling: fingerprints of documents as weighted sets of words."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.shared import whole_text
from basketlens.session import staged

#: Samples of a fingerprint, and how many of them one row of the intermediate table holds.
SAMPLES, GROUP = 32, 8
#: Documents of one bucket, whose words are counted in one task, and the most ranges of doc_id that are looked for;
#: what is more is cut into buckets within the ranges.
BUCKET_ROWS, RANGES = 2000, 1 << 10
_WORD_BREAK = r"[\x20\x09-\x0D]+"
#: A sample is 31 bits of a hash; none stands for a document without words.
_SAMPLE, _NONE = (1 << 31) - 1, -1


def _uniform(bits: Column, shift: int, size: int) -> Column:
    """A number above 0 and below 1 from `size` bits of a hash."""
    cut = F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit((1 << size) - 1))
    return (cut + F.lit(0.5)) / F.lit(float(1 << size))


def _draws(rows: DataFrame) -> DataFrame:
    """For each of GROUP samples from number `first` on: r and the logarithm of c, which are gamma(2, 1), and beta, uniform.

    They depend on the term and the number of the sample alone.
    """
    numbers = [F.col("first") + F.lit(j) for j in range(GROUP)]
    rows = rows.withColumns({f"u{j}": F.xxhash64("term", k, F.lit(0)) for j, k in enumerate(numbers)})
    rows = rows.withColumns({f"v{j}": F.xxhash64("term", k, F.lit(1)) for j, k in enumerate(numbers)})
    draws = {}
    for j in range(GROUP):
        u, v = F.col(f"u{j}"), F.col(f"v{j}")
        draws[f"r{j}"] = -F.log(_uniform(u, 0, 21) * _uniform(u, 21, 21))
        draws[f"beta{j}"] = _uniform(u, 42, 22)
        draws[f"log_c{j}"] = F.log(-F.log(_uniform(v, 0, 21) * _uniform(v, 21, 21)))
    return rows.withColumns(draws)


def _sample(j: int, log_weight: Column) -> Column:
    """What is least in the term that is sampled: the logarithm of a = c / (y e^r) in the upper bits, the sample below."""
    r, beta = F.col(f"r{j}"), F.col(f"beta{j}")
    t = F.floor(log_weight / r + beta)
    rank = ((F.col(f"log_c{j}") - r * (t - beta + 1) + 128) * F.lit(float(1 << 24))).cast("long")
    name = F.xxhash64("term", t, F.col("first") + F.lit(j)).bitwiseAND(F.lit(_SAMPLE))
    return F.shiftleft(rank, 31).bitwiseOR(name)


def signatures(texts: DataFrame, *key: str, sides: tuple[str, ...] = ("text",)) -> DataFrame:
    """For each row, named by `key`, and each of the text columns `sides`: SAMPLES samples of the words of the text.

    Two texts have a sample in common with the probability of their generalised Jaccard similarity (sum of the lesser
    by sum of the larger word counts). Where rows are already dealt out by the first key, nothing is shuffled. A
    document of any length is counted word by word, never held as a whole.
    """
    both = F.explode(F.array(*[F.struct(F.lit(i).alias("side"), F.col(s).alias("text")) for i, s in enumerate(sides)])).alias("t")
    rows = texts.select(*key, both).select(*key, "t.side", F.explode_outer(F.array_remove(F.split("t.text", _WORD_BREAK), "")).alias("word"))
    hashed = rows.select(*key, "side", F.when(F.col("word").isNotNull(), F.xxhash64("word")).alias("term"))
    weights = [F.count(F.when(F.col("side") == i, F.col("term"))).alias(f"w{i}") for i in range(len(sides))]
    counted = hashed.groupBy(*key, "term").agg(*weights)
    logs = {f"log_w{i}": F.when(F.col(f"w{i}") > 0, F.log(f"w{i}")) for i in range(len(sides))}
    spread = counted.withColumns(logs).select("*", F.explode(F.array(*[F.lit(k) for k in range(0, SAMPLES, GROUP)])).alias("first"))
    names = [[f"s{i}_{j}" for j in range(GROUP)] for i in range(len(sides))]
    least = [F.min(_sample(j, F.col(f"log_w{i}"))).alias(names[i][j]) for i in range(len(sides)) for j in range(GROUP)]
    sampled = _draws(spread).groupBy(*key, "first").agg(*least)
    slots = [
        F.array(*[F.coalesce(F.col(n).bitwiseAND(F.lit(_SAMPLE)).cast("int"), F.lit(_NONE)) for n in names[i]]).alias(f"part{i}")
        for i in range(len(sides))
    ]
    parts = sampled.select(*key, F.struct("first", *slots).alias("part")).groupBy(*key).agg(F.sort_array(F.collect_list("part")).alias("parts"))
    whole = [F.flatten(F.transform("parts", lambda p: p[f"part{i}"])).alias(f"{s}_signature") for i, s in enumerate(sides)]
    return parts.select(*key, *whole)


def likeness(a: Column, b: Column) -> Column:
    """The share of samples that two signatures have in common."""
    same = F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)
    return F.size(same) / F.lit(float(SAMPLES))


def as_text(signature: Column) -> Column:
    """A signature as eight hexadecimal digits a sample."""
    return F.array_join(F.transform(signature, lambda x: F.lower(F.lpad(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))), "")


def _bounds(docs: DataFrame) -> tuple[list[int], int]:
    """Values of doc_id that cut the rows into at most RANGES even ranges, the least and the greatest among them, and the
    number of buckets of a range: a few numbers, whatever the rows hold."""
    rows = docs.agg(F.count("doc_id")).first()[0]
    ranges = min(math.ceil(rows / BUCKET_ROWS), RANGES)
    if ranges < 2:
        return [], 1
    shares = [i / ranges for i in range(ranges + 1)]
    found = docs.agg(F.percentile_approx("doc_id", shares, max(10_000, 20 * ranges))).first()[0]
    return sorted(set(found)), math.ceil(rows / (ranges * BUCKET_ROWS))


def _bucket(bounds: list[int], slices: int) -> Column:
    """The bucket of a doc_id, never less for a greater one; -1 where it is null.

    The range is the number of inner bounds at or below the id, by binary search; `slices` buckets of a range are
    equally wide.
    """
    if len(bounds) < 2:
        return F.when(F.col("doc_id").isNull(), -1).otherwise(0).cast("long")
    values = F.array(*[F.lit(b).cast("long") for b in bounds[1:-1]]).cast("array<bigint>")
    start = F.struct(F.lit(0).alias("low"), F.lit(len(bounds) - 2).alias("high"), values.alias("at"))

    def step(s: Column, _: Column) -> Column:
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        above = (s["low"] < s["high"]) & (F.get(s["at"], middle) <= F.col("doc_id"))
        low = F.when(above, middle + 1).otherwise(s["low"])
        high = F.when((s["low"] < s["high"]) & ~above, middle).otherwise(s["high"])
        return F.struct(low.alias("low"), high.alias("high"), s["at"].alias("at"))

    steps = F.array(*[F.lit(0)] * (len(bounds).bit_length() + 1))
    place = F.aggregate(steps, start, step)["low"].cast("long")
    if slices > 1:
        edges = F.array(*[F.lit(float(b)) for b in bounds])
        low, high = F.get(edges, place.cast("int")), F.get(edges, place.cast("int") + 1)
        part = F.floor((F.col("doc_id").cast("double") - low) / (high - low) * slices)
        place = place * slices + F.least(F.greatest(part, F.lit(0)), F.lit(slices - 1))
    return F.when(F.col("doc_id").isNull(), F.lit(-1).cast("long")).otherwise(place)


def _linked(seen: DataFrame, slices: int) -> DataFrame:
    """Buckets that hold rows with `next_bucket`, the next lower of them; the greatest after the least.

    Only numbers go through the windows: those of a range through one, one a range through the other.
    """
    ranged = seen.withColumn("range", F.floor(F.col("bucket") / slices))
    inside = Window.partitionBy("range").orderBy(F.desc("bucket"))
    downward = Window.orderBy(F.desc("range"))
    everywhere = downward.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tops = ranged.groupBy("range").agg(F.max("bucket").alias("top"))
    follow = tops.select("range", F.coalesce(F.lead("top").over(downward), F.first("top").over(everywhere)).alias("follow"))
    within = ranged.withColumn("lower", F.lead("bucket").over(inside))
    return within.join(follow, "range").select(*seen.columns, F.coalesce("lower", "follow").alias("next_bucket"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """The fingerprint of every whole text and of its edited text: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited and near_next.

    The next document is the one with the next lower doc_id (rows with one doc_id in the order of their texts, null
    ids last; after the last the first): the edited text has its beginning instead of the text's last half. Rows are dealt
    out by ranges of doc_id; only the first document of each bucket is looked up by another. Rows of one doc_id, or of
    none, are one bucket, which is sorted and may spill. Columns beside doc_id and text are left out. A null text is an empty
    one; a very long text is counted word by word; a text without words is like such texts only; a single row is its own next one; an empty table gives no row.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    bounds, slices = _bounds(own.select("doc_id"))
    bucket = _bucket(bounds, slices)
    rows = own.withColumn("bucket", bucket)
    # the first document of each bucket: its id, then its text, which goes to the bucket before
    seen = own.select("doc_id").withColumn("bucket", bucket).groupBy("bucket").agg(F.max("doc_id").alias("doc_id"))
    links = staged(_linked(seen, slices), "links")
    firsts = links.select("bucket", F.col("doc_id").alias("first_id"))
    found = own.join(firsts, F.col("doc_id").eqNullSafe(F.col("first_id"))).groupBy("bucket").agg(F.min("text").alias("after"))
    chain = links.select("bucket", "next_bucket")
    after = staged(chain.join(found.withColumnRenamed("bucket", "next_bucket"), "next_bucket").drop("next_bucket"), "after")
    order = Window.partitionBy("bucket").orderBy(F.col("doc_id").desc_nulls_last(), "text")
    placed = rows.join(after, "bucket").withColumns({"place": F.row_number().over(order), "next": F.lead("text").over(order)})
    size = F.char_length("text")
    half = F.floor(size / 2).cast("int")
    edited = F.concat(F.left(F.col("text"), size - half), F.left(F.coalesce("next", "after"), half))
    texts = placed.select("bucket", "place", "doc_id", "text", edited.alias("edited"))
    named = texts.select("bucket", "place", "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"))
    sampled = signatures(texts, "bucket", "place", sides=("text", "edited"))
    signed = staged(named.join(sampled, ["bucket", "place"]), "signed")
    border = signed.where("place = 1").select(F.col("bucket").alias("next_bucket"), F.col("text_signature").alias("after"))
    next_border = staged(chain.join(border, "next_bucket").drop("next_bucket"), "border")
    follow = F.lead("text_signature").over(Window.partitionBy("bucket").orderBy("place"))
    final = signed.join(next_border, "bucket").withColumn("next_signature", F.coalesce(follow, F.col("after")))
    return final.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("text_signature")).alias("fingerprint"),
        as_text(F.col("edited_signature")).alias("edited_fingerprint"),
        likeness(F.col("text_signature"), F.col("edited_signature")).alias("near_edited"),
        likeness(F.col("text_signature"), F.col("next_signature")).alias("near_next"),
    )
