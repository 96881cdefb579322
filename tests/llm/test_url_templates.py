"""URL verdicts: host and path, rules, templates and their purity."""

import re

import pytest
from pyspark.sql import functions as F

from basketlens.llm import url_templates

URLS = [
    "http://A.Example.NET/en/1?x#y",
    "https://example.net/en/",
    "https://example.net/EN/",
    "https://net/x",
    "https://net",
    "https://m.example.com/de/7#top",
    "http://xexample.com/de/7",
    "http://b.org/fr/a/b",
    "http://b.org/frx",
    "ftp://user@h.org:80/p://q/r?://",
    "no scheme/at/all",
    "",
    None,
    "://",
    "http://?q",
    "http://ÄÖ.org/Ünï/x",
    "http://long.org/" + "/".join(map(str, range(300))),
]


def plain(url):
    url = url or ""
    host, path = "", ""
    if "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = None
    for kind, rule in url_templates.RULES:
        own, _, prefix = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + prefix) and len(rule) > len((best or ("", ""))[1]):
            best = (kind, rule)
    return host, path, best


@pytest.fixture()
def no_labels(spark):
    return spark.createDataFrame([], "page_id long, bad boolean")


def test_hosts_paths_and_rules(spark, no_labels):
    pages = spark.createDataFrame([(i, u, "h", "b") for i, u in enumerate(URLS)], "page_id long, url string, html string, bad string")
    found = {r.page_id: r for r in url_templates.judged_urls(pages, no_labels).collect()}
    assert len(found) == len(URLS)
    for i, url in enumerate(URLS):
        host, path, rule = plain(url)
        assert (found[i].host, found[i].path) == (host, path)
        assert (found[i].rule, found[i].verdict) == ((rule[1], rule[0]) if rule else (None, "allow"))


def pages_of(spark, urls):
    return spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")


def test_variable_segments_become_wildcards(spark, no_labels):
    urls = [f"http://h.org/shop/item-{chr(97 + i // 26)}{chr(97 + i % 26)}/view" for i in range(60)] + ["http://h.org/about/us"] * 60
    found = url_templates.judged_urls(pages_of(spark, urls), no_labels)
    assert {r.template for r in found.select("template").distinct().collect()} == {"shop/*/view", "about/us"}


def test_branches_below_a_wildcard_are_one(spark):
    names = [f"{a}{b}" for a in "abcdef" for b in "uvwxyz"]
    # thousands of names in a real shop, a few titles each: alone no branch has enough pages to be judged
    urls = [f"http://h.org/shop/{n}/{n}-{t}/view" for n in names for t in "pq"] + ["http://h.org/about/us"] * 100
    labels = spark.createDataFrame([(i, "/shop/" in u) for i, u in enumerate(urls)], "page_id long, bad boolean")
    found = url_templates.judged_urls(pages_of(spark, urls), labels).collect()
    assert {(r.template, r.verdict) for r in found} == {("shop/*/*/view", "block"), ("about/us", "allow")}


def test_pages_are_labelled_by_the_document_they_show(spark, tmp_path):
    from basketlens.llm.queries import op6_url_templates

    urls = [f"http://good.org/en/{i}" for i in range(100, 140)] + [f"http://bad.org/en/{i}.html" for i in range(200, 240)]
    pages_of(spark, urls).write.parquet(f"{tmp_path}/pages.parquet")
    labels = [(i, 1, 0) for i in range(140)] + [(i, 0, 0) for i in range(200, 230)] + [(i, 1, 1) for i in range(230, 240)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    found = op6_url_templates(spark, str(tmp_path)).collect()
    assert {(r.host, r.verdict) for r in found} == {("good.org", "allow"), ("bad.org", "block")}


def test_bad_branches_are_rejected_and_like_ones_merged(spark):
    urls = [f"http://h.org/{b}/{i}" for b in ("good", "bad", "fine") for i in range(40)]
    labels = [(i, "/bad/" in u if i % 40 < 38 else i % 2 == 0) for i, u in enumerate(urls)]
    # `rare` has two bad labels, too few to go by, but it is unlike its siblings; the overall share holds it back
    urls += [f"http://h.org/rare/{i}" for i in range(5)]
    labels += [(len(urls) - 1, True), (len(urls) - 2, True), (None, True), (3, None)]
    bad = spark.createDataFrame(labels, "page_id long, bad boolean")
    found = url_templates.judged_urls(pages_of(spark, urls), bad)
    verdicts = {(r.path.split("/")[1], r.verdict) for r in found.collect()}
    assert verdicts == {("good", "allow"), ("fine", "allow"), ("bad", "block"), ("rare", "allow")}


def test_repeated_rows_null_ids_and_empty_table(spark, no_labels):
    pages = spark.createDataFrame([(1, URLS[0])] * 3 + [(None, URLS[0]), (None, None)], "page_id long, url string")
    assert url_templates.judged_urls(pages, no_labels).count() == 5
    assert url_templates.judged_urls(pages.where(F.lit(False)), no_labels).count() == 0
