"""Sitemap parts, whole runs, URL lists and restarted streams."""

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from docweave.functions.select import select_html
from docweave.functions.urls import normalize_url
from docweave.operators import assemble as A
from docweave.operators import harvest as R
from docweave.operators import stats
from docweave.operators.crawl import canonical_edges
from docweave.plans import q_spec
from docweave.sources import spec as SP
from docweave.sources.tables import pages
from docweave.streaming import stream as ST


@pytest.mark.parametrize("max_locs", [1, 2, 50_000])
def test_no_listed_page_is_lost_when_sitemaps_have_parts(spark, max_locs):
    n = pages(spark, SF0001).count()
    listed = q_spec.expanded_items(spark, SF0001, max_locs)
    assert listed.where("is_sitemap").count() == 0
    assert listed.count() == 3 * n  # own page and seed of each spec, and every page once in a sitemap
    found = [r.url for r in listed.where("size(selectors) = 2").select("url").collect()]
    assert sorted(found) == sorted(r.url for r in pages(spark, SF0001).select(normalize_url(F.col("url")).alias("url")).collect())


def _item(spec, pos, url, deep=False, sitemap=False, selectors=()):
    return (spec, pos, "folder_per_domain", url, sitemap, deep, list(selectors), False, True, 1, 10, "")


ITEM = ("spec_id int, pos int, persistence string, url string, is_sitemap boolean, should_scrap boolean, selectors array<string>, "
        "include_external boolean, include_subdomains boolean, max_depth int, max_pages int, paths_to_skip_regex string")


def run_of(spark):
    items = spark.createDataFrame([
        _item(1, 0, "https://oak.test/map.xml", sitemap=True, selectors=["main"]),
        _item(1, 1, "https://oak.test/b/"),           # listed by the sitemap already
        _item(1, 2, "https://oak.test/", deep=True),
        _item(1, 3, "https://oak.test/lost"),          # no capture
        _item(1, 4, "https://oak.test/c", selectors=["main + p"]),  # not supported: nothing is saved
    ], ITEM)
    locs = spark.createDataFrame([("https://oak.test/map.xml", 0, "https://oak.test/b#x"), ("https://oak.test/map.xml", 1, "https://oak.test/a")],
                                 "sitemap_url string, pos int, loc string")
    items = SP.dedup_items(SP.expand_sitemaps(items, locs), ["spec_id"])
    html = "<body><p>menu</p><main><p>text {0}</p></main></body>"
    fetch = spark.createDataFrame(
        [(i, f"https://oak.test/{u}", u != "broken", html.format(u)) for i, u in enumerate(["", "a", "b", "c", "z", "broken"])],
        "page_id long, url string, success boolean, html string")
    edges = spark.createDataFrame([("https://oak.test/", "https://oak.test/" + u) for u in ("z", "broken", "a")], "src string, dst string")
    videos = spark.createDataFrame([(1, "folder_per_domain", 0, "https://youtu.be/abcdefghijk"), (1, "folder_per_domain", 1, "https://oak.test/x")],
                                   "spec_id int, persistence string, pos int, url string")
    talk = spark.createDataFrame([("abcdefghijk", "[0:00:01]<v>hello")], "video_id string, transcript string")
    return R.harvest(items, videos, fetch, canonical_edges(edges), talk)


def test_run_keeps_order_selectors_and_first_items(spark):
    rows = run_of(spark).orderBy("ord").collect()
    assert [(r.phase, r.pos, r.sub, r.depth, r.url.replace("https://oak.test", "") or "/") for r in rows] == [
        (0, 0, 0, 0, "https://www.youtube.com/watch?v=abcdefghijk"),
        (1, 0, 0, 0, "/b"), (1, 0, 1, 0, "/a"),
        (2, 2, 0, 0, "/"), (2, 2, 0, 1, "/a"), (2, 2, 0, 1, "/z")]
    assert "hello" in rows[0].content
    assert "menu" not in rows[1].content and "text b" in rows[1].content
    assert "menu" in rows[5].content


def test_run_reaches_the_sink(spark, tmp_path):
    saved = A.saves(run_of(spark))
    A.write_documents(saved, str(tmp_path / "d"), "file_per_domain").collect()
    text = (tmp_path / "d" / "oak.test.md").read_text()
    assert [text.index(f"text {u}") for u in "baz"] == sorted(text.index(f"text {u}") for u in "baz")
    A.write_documents(saved, str(tmp_path / "f"), "folder_per_domain").collect()
    assert "menu" in (tmp_path / "f" / "oak.test" / "a.md").read_text()  # the crawl came last


def test_unsupported_selector_gives_null():
    assert select_html("<p>x</p>", ["div > p"]) is None
    assert select_html("<p>x</p>", ["p"]) == "<p>x</p>"


def test_run_urls_count_on_over_depths(spark):
    df = spark.createDataFrame([("i", 0, "z"), ("i", 1, "b"), ("i", 1, "a"), ("i", 2, "c"), ("j", 0, "q")], "item_id string, depth int, url string")
    got = {(r.item_id, r.position): r.url for r in stats.run_urls(df).collect()}
    assert got == {("i", 1): "z", ("i", 2): "a", ("i", 3): "b", ("i", 4): "c", ("j", 1): "q"}


def test_streams_go_on_at_their_location(spark, tmp_path):
    table = tmp_path / "in" / "pages.parquet"
    rows = pages(spark, SF0001).select("page_id", "url", "html")
    half = rows.where("page_id % 2 = 0")

    def drain():
        stream = ST.read_pages_stream(spark, str(tmp_path / "in"))
        docs = ST.run_to_parquet(ST.page_documents(stream), spark, "documents", location=str(tmp_path / "docs"))
        counts = ST.stream_stats(ST.read_pages_stream(spark, str(tmp_path / "in")), spark, location=str(tmp_path / "stats"))
        return docs.count(), docs.select("page_id").distinct().count(), counts.agg(F.sum("pages")).first()[0]

    half.repartition(3).write.parquet(str(table))
    assert drain() == (half.count(),) * 3
    assert drain() == (half.count(),) * 3  # nothing new: no repeats
    rows.where("page_id % 2 <> 0").repartition(2).write.mode("append").parquet(str(table))
    assert drain() == (rows.count(),) * 3


def test_stream_dedup_with_arrival_time(spark, tmp_path):
    rows = [("http://a/x", "2024-01-01 00:00:00"), ("http://a/x#1", "2024-01-01 00:10:00"), ("http://a/y", "2024-01-01 00:20:00")]
    spark.createDataFrame(rows, "url string, at string").selectExpr("url", "cast(at as timestamp) at").write.parquet(str(tmp_path / "t"))
    stream = spark.readStream.schema("url string, at timestamp").parquet(str(tmp_path / "t"))
    out = ST.run_to_parquet(ST.stream_dedup(stream, "at", "1 hour").select("key"), spark, "dedup", location=str(tmp_path / "o"))
    assert sorted(r.key for r in out.collect()) == ["http://a/x", "http://a/y"]


def test_references_read_no_text_and_saves_may_carry_a_measure(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def page(i):
        made.add(1)
        return f"<body><p>text {'x' * i}</p></body>"

    items = spark.createDataFrame([_item(1, 0, "https://oak.test/a"), _item(2, 0, "https://oak.test/a/"), _item(2, 1, "https://oak.test/", deep=True)], ITEM)
    items = items.withColumn("sub", F.lit(0).cast("bigint"))
    rows = spark.createDataFrame([(0, "https://oak.test/", True), (1, "https://oak.test/a", True), (2, "https://oak.test/z", False)],
                                 "page_id long, url string, success boolean")
    fetch = rows.withColumn("html", page("page_id"))
    edges = canonical_edges(spark.createDataFrame([("https://oak.test/", "https://oak.test/a")], "src string, dst string"))
    refs = R.page_references(items, fetch, edges).collect()
    assert len(refs) == 4 and made.value == 0
    videos = spark.createDataFrame([], "spec_id int, persistence string, pos int, url string")
    talk = spark.createDataFrame([], "video_id string, transcript string")
    texts = R.harvest(items, videos, fetch, edges, talk).collect()
    sizes = R.harvest(items, videos, fetch, edges, talk, F.length).collect()
    key = lambda r: (r.spec_id, r.phase, r.url)
    assert sorted((*key(r), len(r.content)) for r in texts) == sorted((*key(r), r.content) for r in sizes) and len(sizes) == 4
