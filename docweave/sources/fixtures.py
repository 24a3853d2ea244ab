"""Derived inputs (FIXTURES.md part B), computed by Spark from the driver
tables so their size grows with the tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame.  None of them
uses a cross join or emits all pairs within a group: the URL variants come
from a fixed generator array, the link graph from an equi-join on
``(host, target rank)``, and ranks from the block-wise ordinal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.constants import SITEMAP_MAX_LOCS
from docweave.operators.windows import ordinal_within
from docweave.sources.tables import conversations, pages

HOST_RE = r"^https?://([^/?#]+)"

# The eight URL variant suffixes of the url_variants fixture.
URL_VARIANT_SUFFIXES = [
    (0, ""), (1, "/"), (2, "#x"), (3, "?utm_source=a&b=1"),
    (4, "?b=1&a=2&b=3"), (5, "?b=&a=2&flag"), (6, "/?utm_medium=m"), (7, "?q=x%20y&utm_id=7"),
]


def raw_host(url) -> F.Column:
    return F.regexp_extract(url, HOST_RE, 1)


def url_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(uid, variant, url)``: eight spellings of every page URL."""
    gen = F.array(*[F.struct(F.lit(k).alias("variant"), F.lit(s).alias("sfx")) for k, s in URL_VARIANT_SUFFIXES])
    p = pages(spark, sf_dir).select("page_id", "url", F.inline(gen))
    return p.select(
        (F.col("page_id") * 8 + F.col("variant")).alias("uid"),
        F.col("variant"),
        F.concat(F.regexp_replace("url", r"[?#].*$", ""), F.col("sfx")).alias("url"),
    )


def ranked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(page_id, host, url, rn)``, ``rn`` = rank of the page in its host by id."""
    p = pages(spark, sf_dir).select("page_id", "url", raw_host(F.col("url")).alias("host"))
    return ordinal_within(p, ["host"], "page_id", "rn", dense=True)


def derived_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(src, dst)``: per host a binary tree over ranks plus back edges to the
    root.  Each source emits its (at most three) target ranks and joins on
    ``(host, rank)``; the root key is hot, which AQE's skew join splits."""
    r = ranked_pages(spark, sf_dir)
    targets = r.select(
        "host", F.col("url").alias("src"),
        F.explode(F.array(F.col("rn") * 2, F.col("rn") * 2 + 1, F.when(F.col("rn") > 1, F.lit(1)))).alias("trn"),
    ).where(F.col("trn").isNotNull())
    dst = r.select("host", F.col("rn").alias("trn"), F.col("url").alias("dst"))
    return targets.join(dst, ["host", "trn"]).select("src", "dst")


def derived_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(page_id, url, html)``: the pages with the links of ``derived_links``
    (at most three a page) as anchors at the end, absolute and relative ones."""
    link = F.col("dst")
    path = F.regexp_replace(link, r"^https?://[^/?#]+", "")
    href = F.when(path.startswith("/"), path).otherwise(link)
    anchors = derived_links(spark, sf_dir).groupBy(F.col("src").alias("url")).agg(
        F.array_join(F.array_sort(F.collect_list(F.concat(F.lit('<a href="'), href, F.lit('">more</a>')))), " ").alias("anchors"))
    return pages(spark, sf_dir).join(anchors, "url", "left").select(
        "page_id", "url", F.concat("html", F.coalesce("anchors", F.lit(""))).alias("html"))


def derived_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(host, url)``: the lowest-id page of each host (partial aggregate)."""
    p = pages(spark, sf_dir).select("page_id", "url", raw_host(F.col("url")).alias("host"))
    return p.groupBy("host").agg(F.min_by("url", "page_id").alias("url"))


def derived_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(page_id, url, success, html)`` with some failures and blank pages."""
    return pages(spark, sf_dir).select(
        "page_id", "url",
        (F.col("page_id") % 17 != 0).alias("success"),
        F.when(F.col("page_id") % 13 == 0, F.lit(" ")).otherwise(F.col("html")).alias("html"),
    )


def _pad_id(c) -> F.Column:
    return F.lpad(c.cast("string"), 11, "a")


def derived_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(conv_id, url)``: one video URL per conversation in five spellings."""
    conv = conversations(spark, sf_dir).select("conv_id").distinct()
    vid = _pad_id(F.col("conv_id"))
    kind = (F.col("conv_id") % 5).cast("int")
    url = (
        F.when(kind == 0, F.concat(F.lit("https://www.youtube.com/watch?v="), vid))
        .when(kind == 1, F.concat(F.lit("https://youtu.be/"), vid))
        .when(kind == 2, F.concat(F.lit("https://www.youtube.com/embed/"), vid))
        .when(kind == 3, F.concat(F.lit("https://www.youtube.com/watch?t=9&v="), vid))
        .otherwise(F.lit("https://www.youtube.com/watch?v=invalid123"))
    )
    return conv.select("conv_id", url.alias("url"))


def derived_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(video_id, seq, lang, is_generated, text)`` caption snippets."""
    c = conversations(spark, sf_dir)
    return c.select(
        _pad_id(F.col("conv_id")).alias("video_id"),
        F.col("turn").alias("seq"),
        F.when(F.col("conv_id") % 7 == 0, F.lit("de")).otherwise(F.lit("en")).alias("lang"),
        (F.col("role") != "system").alias("is_generated"),
        F.concat(F.lit("[0:00:"), F.col("turn").cast("string"), F.lit("]<spk>"), F.col("text")).alias("text"),
    )


def sitemap_url(host, part) -> F.Column:
    """URL of a part of a host's sitemap: ``/sitemap.xml``, ``/sitemap-1.xml``, ..."""
    name = F.when(part == 0, F.lit("/sitemap.xml")).otherwise(F.concat(F.lit("/sitemap-"), part.cast("string"), F.lit(".xml")))
    return F.concat(F.lit("https://"), host, name)


def derived_sitemaps(spark: SparkSession, sf_dir: str, max_locs: int = SITEMAP_MAX_LOCS) -> DataFrame:
    """``(host, part, xml)``: per host the sitemap(s) listing its pages in id
    order, split at the protocol's 50,000-URL limit so no sitemap grows with
    the host."""
    r = ranked_pages(spark, sf_dir)
    r = r.withColumn("part", F.floor((F.col("rn") - 1) / max_locs).cast("bigint"))
    entry = F.concat(F.lit("<url><loc>"), F.replace(F.col("url"), F.lit("&"), F.lit("&amp;")), F.lit("</loc></url>"))
    body = F.expr("listagg(__entry, '') WITHIN GROUP (ORDER BY page_id)")
    return (
        r.withColumn("__entry", entry)
        .groupBy("host", "part")
        .agg(body.alias("body"))
        .select(
            "host", "part",
            F.concat(F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), F.col("body"), F.lit("</urlset>")).alias("xml"),
        )
    )


def deep_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deep-crawl items, one per seed host, with settings that vary by host
    so every filter and the page budget are exercised."""
    s = derived_seeds(spark, sf_dir)
    h = F.col("host")
    return s.select(
        h.alias("item_id"),
        F.col("url"),
        (~h.startswith("m.")).alias("include_subdomains"),
        F.lit(False).alias("include_external"),
        F.lit(2).alias("max_depth"),
        F.when(h.startswith("blog."), F.lit(3)).otherwise(F.lit(100)).alias("max_pages"),
        F.when(h.startswith("www."), F.lit("/(de|es)/")).otherwise(F.lit("")).alias("paths_to_skip_regex"),
    )


def filter_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(item_id, src, variant, url)``: every link target of a host's pages,
    as found and re-spelled on a look-alike host, a foreign host and a
    subdomain, offered to the host's item."""
    links = derived_links(spark, sf_dir)
    dst = F.col("dst")
    spellings = F.array(
        F.struct(F.lit(0).alias("variant"), dst.alias("url")),
        F.struct(F.lit(1).alias("variant"), F.regexp_replace(dst, r"^(https?://)([^/?#]+)", "$1$2.evil.example").alias("url")),
        F.struct(F.lit(2).alias("variant"), F.regexp_replace(dst, r"^(https?://)([^/?#]+)", "$1other.example.org").alias("url")),
        F.struct(F.lit(3).alias("variant"), F.regexp_replace(dst, r"^(https?://)(?:www\.)?([^/?#]+)", "$1docs.$2").alias("url")),
    )
    return links.select(raw_host(F.col("src")).alias("item_id"), "src", F.inline(spellings))
