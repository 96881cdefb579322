"""URL verdicts by rules, and where none fits by a tree of path templates with labelled purity."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.shared import ascii_lower
from basketlens.session import staged

# Rules (verdict, host and path prefix).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

# What a segment looks like, tried in this order; anything else stands for itself.
SHAPES = (
    (r"^[0-9]+$", "{n}"),
    (r"^[0-9]+[.][A-Za-z]+$", "{n}.ext"),
    (r"^[0-9A-Fa-f]{8,}$", "{hex}"),
    (r"^[^0-9]*[0-9][^0-9]*[0-9]", "{id}"),
)


@dataclass(frozen=True)
class Purity:
    """When a template's labelled pages are too bad.

    children, share: a branch with more different segments than both is one wildcard. z: siblings whose share of bad
    pages is nearer than that many standard errors to that of all siblings are one branch. weight: labelled pages
    of the overall share that are added to a branch's own. bad: smoothed share from which a branch is rejected.
    """

    children: int = 16
    share: float = 0.25
    z: float = 1.96
    weight: float = 10.0
    bad: float = 0.5


PURITY = Purity()


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without `://`."""
    place = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(place > 0, F.substr(url, place + 3)).otherwise(F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits a URL and its verdict; null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule in sorted(rules, key=lambda r: len(r[1])):
        own, _, prefix = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith("/" + prefix)
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def _shape(segment: Column) -> Column:
    found = segment
    for pattern, shape in reversed(SHAPES):
        found = F.when(F.rlike(segment, F.lit(pattern)), F.lit(shape)).otherwise(found)
    return found


def _generalised(paths: DataFrame, purity: Purity) -> DataFrame:
    """paths with `parts`: their segments, those of variable branches as '*'.

    Level by level: a level is grouped by what the levels above it have become, so branches below a wildcard are one. A
    branch with `children` paths or fewer can't become variable further down; its paths are done, and the loop ends
    with the last larger branch.
    """
    active, done, depth = paths.withColumn("parts", F.array().cast("array<string>")), None, 0
    while True:
        depth += 1
        size = active.groupBy("host", "parts").agg(F.count(F.lit(1)).alias("below"))
        marked = active.join(size, ["host", "parts"])
        further = (F.col("below") > purity.children) & (F.size("segments") >= depth)
        rest = F.slice("segments", depth, F.greatest(F.size("segments") - depth + 1, F.lit(0)))
        ended = staged(marked.where(~further).withColumn("parts", F.concat("parts", rest)).select(*active.columns), "ended")
        done = ended if done is None else done.union(ended)
        going = staged(marked.where(further).withColumn("segment", F.col("segments")[depth - 1]).drop("below"), "level")
        if going.isEmpty():
            return done
        # each segment is counted once before
        children = going.groupBy("host", "parts", "segment").agg(F.sum("n").alias("n"))
        variable = (
            children.groupBy("host", "parts")
            .agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"))
            .where((F.col("k") > purity.children) & (F.col("k") > purity.share * F.col("n")))
            .select("host", "parts", F.lit("*").alias("wildcard"))
        )
        found = going.join(variable, ["host", "parts"], "left")
        parts = F.concat("parts", F.array(F.coalesce("wildcard", "segment")))
        active = staged(found.withColumn("parts", parts).select(*active.columns), "level")


def templates(urls: DataFrame, purity: Purity = PURITY) -> DataFrame:
    """The templates of urls (host, segments, bad: true, false or null where not labelled): host, segments, template,
    labelled, bad_pages, bad_share and rejected, one row for each different (host, segments).

    segments are shapes already, so there are few different ones a host; everything is counted before it is shuffled.
    """
    labelled, bad = F.count("bad").alias("labelled"), F.count(F.when(F.col("bad"), 1)).alias("bad_pages")
    paths = staged(urls.groupBy("host", "segments").agg(F.count(F.lit(1)).alias("n"), labelled, bad), "paths")
    named = _generalised(paths, purity)
    named = staged(
        named.select(
            "host",
            "segments",
            "labelled",
            "bad_pages",
            F.array_join("parts", "/").alias("template"),
            F.size("parts").alias("depth"),
            F.array_join(F.slice("parts", 1, F.greatest(F.size("parts") - 1, F.lit(0))), "/").alias("parent"),
        ),
        "templates",
    )
    count = [F.sum("labelled").alias("labelled"), F.sum("bad_pages").alias("bad_pages")]
    branches = named.groupBy("host", "depth", "parent", "template").agg(*count)
    siblings = branches.groupBy("host", "depth", "parent").agg(F.sum("labelled").alias("all_labelled"), F.sum("bad_pages").alias("all_bad"))
    whole = named.agg(F.coalesce(F.sum("labelled"), F.lit(0)), F.coalesce(F.sum("bad_pages"), F.lit(0))).first()
    prior = whole[1] / whole[0] if whole[0] else 0.0
    # a branch differs from its siblings if its share of bad pages is too far from theirs
    share, error = F.col("all_bad") / F.col("all_labelled"), F.col("bad_pages") / F.col("labelled")
    far = F.abs(error - share) > purity.z * F.sqrt(share * (1 - share) / F.col("labelled"))
    compared = branches.join(siblings, ["host", "depth", "parent"]).withColumn(
        "alike", F.when((F.col("labelled") > 0) & (F.col("all_labelled") > 0), ~far).otherwise(True)
    )
    merged = compared.groupBy("host", "depth", "parent", F.when(~F.col("alike"), F.col("template")).alias("alone")).agg(*count)
    judged = merged.select(
        F.col("host").alias("m_host"),
        F.col("depth").alias("m_depth"),
        F.col("parent").alias("m_parent"),
        "alone",
        "labelled",
        "bad_pages",
        ((F.col("bad_pages") + purity.weight * prior) / (F.col("labelled") + purity.weight)).alias("bad_share"),
    )
    branch = compared.select("host", "depth", "parent", "template", F.when(~F.col("alike"), F.col("template")).alias("own"))
    same = (
        (F.col("host") == F.col("m_host"))
        & (F.col("depth") == F.col("m_depth"))
        & (F.col("parent") == F.col("m_parent"))
        & F.col("own").eqNullSafe(F.col("alone"))
    )
    verdicts = branch.join(judged, same).select("host", "template", "labelled", "bad_pages", "bad_share", (F.col("bad_share") >= purity.bad).alias("rejected"))
    found = named.select("host", "segments", "template").join(verdicts, ["host", "template"])
    return found.select("host", "segments", "template", "labelled", "bad_pages", "bad_share", "rejected")


def judged_urls(pages: DataFrame, labels: DataFrame, rules=RULES, purity: Purity = PURITY) -> DataFrame:
    """page_id, host, path, rule, verdict (block or allow), template and bad_share of every page.

    labels: page_id and bad (a null is no label). Where no rule fits, a page is blocked if its template is rejected. Per host,
    numbers, hashes and ids in a path become wildcards, and so do the segments of branches with too many different
    ones; branches whose labelled pages are alike are merged. A null url, or one without `://`, has an empty host and
    path, like any other such page; repeated rows get the same verdict; an empty table gives no row.
    """
    known = labels.where("page_id is not null and bad is not null").groupBy("page_id").agg(F.max("bad").alias("bad"))
    host, path = host_and_path(F.col("url").cast("string"))
    named = pages.select("page_id", host.alias("host"), path.alias("path"))
    shaped = named.withColumn("segments", F.transform(F.array_remove(F.split("path", "/"), ""), _shape))
    urls = shaped.select("page_id", "host", "segments").join(known, "page_id", "left").select("host", "segments", "bad")
    found = staged(templates(urls, purity), "verdicts").select("host", "segments", "template", "bad_share", "rejected")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return shaped.join(found, ["host", "segments"], "left").select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("rejected"), "block").otherwise("allow")).alias("verdict"),
        "template",
        "bad_share",
    )
