import json

import pytest
from pyspark.sql import functions as F

from docweave.operators import filters as FL
from docweave.sources import spec as SP


def _items(spark, rows):
    df = spark.createDataFrame(rows, "item_id string, url string, include_subdomains boolean, include_external boolean, paths_to_skip_regex string")
    return FL.with_item_checks(df).drop("url")


def test_subdomains_of_the_seed_host_pass(spark):
    items = _items(spark, [("i", "https://wiki.acorn.test/start", True, False, "")])
    verdicts = {"https://wiki.acorn.test/a": True, "http://old.wiki.acorn.test/": True, "https://shop.acorn.test/a": False,
                "https://notwiki.acorn.test/a": False}
    cand = spark.createDataFrame([("i", u) for u in verdicts], "item_id string, url string")
    got = {r.url: r.ok for r in cand.join(items, "item_id").select("url", FL.filter_chain(F.col("url")).alias("ok")).collect()}
    assert got == verdicts


def test_lookahead_skip_pattern(spark):
    items = _items(spark, [("i", "https://acorn.test/", True, False, r"^https://acorn\.test/(?!guide/|$).*")])
    verdicts = {"https://acorn.test/": True, "https://acorn.test/guide/x": True, "https://acorn.test/news/x": False}
    cand = spark.createDataFrame([("i", u) for u in verdicts], "item_id string, url string")
    got = {r.url: r.ok for r in cand.join(items, "item_id").select("url", FL.filter_chain(F.col("url")).alias("ok")).collect()}
    assert got == verdicts


def test_extra_filter_narrows_the_chain(spark):
    items = _items(spark, [("i", "https://acorn.test/", True, False, "")])
    cand = spark.createDataFrame([("i", "https://acorn.test/a"), ("i", "https://acorn.test/a.pdf")], "item_id string, url string")
    extra = [lambda u: ~u.endswith(".pdf")]
    got = cand.join(items, "item_id").where(FL.filter_chain(F.col("url"), extra=extra)).select("url").collect()
    assert [r.url for r in got] == ["https://acorn.test/a"]


def test_invalid_skip_regex_is_reported_and_ignored(spark):
    items = _items(spark, [("i", "http://a.com/", True, False, "(?P<n>x)"), ("j", "http://a.com/", True, False, "/(de|es)/")])
    rows = {r.item_id: r.regex_valid for r in items.select("item_id", "regex_valid").collect()}
    assert rows == {"i": False, "j": True}
    cand = spark.createDataFrame([("i", "http://a.com/de/x"), ("j", "http://a.com/de/x")], "item_id string, url string")
    got = {r.item_id: r.ok for r in cand.join(items, "item_id").select("item_id", FL.filter_chain(F.col("url")).alias("ok")).collect()}
    assert got == {"i": True, "j": False}


def test_exact_domain_literal_semantics(spark):
    items = _items(spark, [("i", "https://www.docs.org/", False, False, "")])
    cand = spark.createDataFrame([("i", u) for u in ["https://docs.org/a", "http://www.docs.org/b", "https://sub.docs.org/c"]], "item_id string, url string")
    got = {r.url: r.ok for r in cand.join(items, "item_id").select("url", FL.exact_domain_filter(F.col("url"), F.col("domain")).alias("ok")).collect()}
    assert got == {"https://docs.org/a": True, "http://www.docs.org/b": True, "https://sub.docs.org/c": False}


SPEC = {
    "items": [
        {"url": "https://alpha.test/handbook/", "should_scrap": True, "maxDepth": 4, "maxPages": 7, "includeExternal": True,
         "includeSubdomains": False, "pathsToSkipRegex": "/(?!v2/)v[0-9]+/", "output_format": "html"},
        {"url": "https://beta.test/one.html", "output_format": ""},
        {"url": "https://gamma.test/map.xml", "is_sitemap": True, "selectors": ["h1", "section.body"]},
        {"url": "https://delta.test/", "shouldScrap": True, "max_depth": 1, "max_pages": 3, "include_external": False,
         "include_subdomains": True, "paths_to_skip_regex": "/tag/"},
    ],
    "persistence_strategy": "file_per_domain",
}


def test_spec_file_aliases_and_defaults(spark, tmp_path):
    p = tmp_path / "jobs.json"
    p.write_text(json.dumps(SPEC, indent=2))
    spec = SP.read_spec_files(spark, str(p)).withColumn("spec_id", F.lit(1))
    items = SP.spec_items(spec, ["spec_id"]).orderBy("pos").collect()
    assert [i.url.split("/")[2] for i in items] == ["alpha.test", "beta.test", "gamma.test", "delta.test"]
    assert [i.should_scrap for i in items] == [True, False, False, True]
    assert [i.is_sitemap for i in items] == [False, False, True, False]
    assert [i.max_pages for i in items] == [7, 100, 100, 3] and [i.max_depth for i in items] == [4, 2, 2, 1]
    assert [i.include_external for i in items] == [True, False, False, False]
    assert [i.include_subdomains for i in items] == [False, True, True, True]
    assert [i.paths_to_skip_regex for i in items] == ["/(?!v2/)v[0-9]+/", "", "", "/tag/"]
    assert {i.persistence for i in items} == {"file_per_domain"}
    assert items[2].selectors == ["h1", "section.body"]
    assert SP.spec_videos(spec, ["spec_id"]).count() == 0


def test_missing_spec_file_fails(spark, tmp_path):
    with pytest.raises(Exception):
        SP.read_spec_files(spark, str(tmp_path / "nope.json")).collect()


def test_sitemap_variants(spark):
    ns = "http://www.sitemaps.org/schemas/sitemap/0.9"
    docs = [
        ("plain", f'<urlset xmlns="{ns}"><url><loc>https://a/1</loc></url><url><loc>https://a/2</loc></url></urlset>'),
        ("prefixed", f'<s:urlset xmlns:s="{ns}"><s:url><s:loc>https://b/1</s:loc></s:url></s:urlset>'),
        ("index", f'<sitemapindex xmlns="{ns}"><sitemap><loc>https://c/sm1.xml</loc></sitemap></sitemapindex>'),
        ("image", f'<urlset xmlns="{ns}" xmlns:image="http://www.google.com/schemas/sitemap-image/1.1"><url><loc>https://d/1</loc>'
                  '<image:image><image:loc>https://d/img.png</image:loc></image:image></url></urlset>'),
        ("nons", "<urlset><url><loc>https://e/1</loc></url></urlset>"),
        ("broken", f'<urlset xmlns="{ns}"><url><loc>https://f/1</loc>'),
    ]
    df = spark.createDataFrame(docs, "name string, xml string")
    got = {}
    for r in SP.sitemap_locs(df, keys=["name"]).collect():
        got.setdefault(r.name, []).append(r.loc)
    assert got.get("plain") == ["https://a/1", "https://a/2"]
    assert got.get("prefixed") == ["https://b/1"]
    assert got.get("index") == ["https://c/sm1.xml"]
    assert got.get("image") == ["https://d/1"]
    assert "nons" not in got and "broken" not in got
