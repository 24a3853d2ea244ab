"""Registered queries: job spec (K-S1, P13, F7), sitemaps (K-S2, A8, J1,
P14, F6, U1) and the dry-run plan (P15).

Specs are derived from the pages table: one small spec document per page
(its page as a flat camelCase item, its host's sitemap as a snake_case
item, its host's seed as a deep item, and its video list), so parsing work
grows with the data while each spec stays bounded.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from docweave.constants import SITEMAP_MAX_LOCS
from docweave.plans import sqlfrag as S
from docweave.plans.registry import register
from docweave.sources import fixtures as X
from docweave.sources import spec as SP

# ------------------------------------------------------------------ specs


def spec_documents(spark, sf, max_locs=SITEMAP_MAX_LOCS):
    """``(spec_id, spec_json)``: one job spec per page.  A part of a host's
    sitemap belongs to one spec, that of the first page it lists."""
    p = X.ranked_pages(spark, sf)
    part = F.floor((F.col("rn") - 1) / max_locs).cast("bigint")
    seeds = X.derived_seeds(spark, sf).select("host", F.col("url").alias("seed"))
    p = p.join(seeds, "host")
    blog = F.col("host").startswith("blog.")
    page_item = F.struct(
        F.col("url").alias("url"),
        F.array(F.lit("article")).alias("selectors"),
        F.when(F.col("page_id") % 3 == 0, F.lit("json")).alias("outputFormat"),
        F.when(F.col("page_id") % 4 == 0, F.lit("")).alias("output_format"),
    )
    sitemap_item = F.struct(
        X.sitemap_url(F.col("host"), part).alias("url"),
        F.lit(True).alias("is_sitemap"),
        F.lit(False).alias("should_scrap"),
        F.array(F.lit("article"), F.lit("main")).alias("selectors"),
        F.lit(50).alias("max_pages"),
    )
    seed_item = F.struct(
        F.col("seed").alias("url"),
        F.lit(True).alias("shouldScrap"),
        F.lit(1).alias("maxDepth"),
        F.when(blog, F.lit(False)).alias("includeSubdomains"),
        F.lit("/(de|es)/").alias("paths_to_skip_regex"),
    )
    spec = F.struct(
        F.struct(F.lit(4).alias("threads"), F.when(F.col("page_id") % 2 == 0, F.lit("markdown")).alias("outputFormat")).alias("defaults"),
        F.array(F.to_json(page_item), F.when((F.col("rn") - 1) % max_locs == 0, F.to_json(sitemap_item)), F.to_json(seed_item)).alias("items_json"),
        F.array(F.concat(F.lit("https://youtu.be/"), F.lpad(F.col("page_id").cast("string"), 11, "a"), F.lit("#t"))).alias("youtube"),
    )
    # items are serialised one by one so each keeps exactly its own keys
    text = F.format_string(
        '{%s"defaults":%s,"items":[%s],"youtube":%s}',
        F.when(blog, F.lit('"persistenceStrategy":"file_per_domain",')).otherwise(F.lit("")),
        F.to_json(spec["defaults"]),
        F.array_join(spec["items_json"], ","),
        F.to_json(spec["youtube"]),
    )
    return p.select(F.col("page_id").alias("spec_id"), text.alias("spec_json"))


def job_spec_items_df(spark, sf, max_locs=SITEMAP_MAX_LOCS):
    return SP.spec_items(SP.parse_spec_text(spec_documents(spark, sf, max_locs)), ["spec_id"])


_ITEMS_SQL = f"""
  specs AS (SELECT r.*, (r.rn - 1) // {SITEMAP_MAX_LOCS} AS part, (r.rn - 1) % {SITEMAP_MAX_LOCS} = 0 AS lists, s.url AS seed
            FROM ranked_pages r JOIN derived_seeds s ON s.host = r.host),
  items AS (
    SELECT page_id AS spec_id, 0 AS pos, url, false AS is_sitemap, false AS should_scrap, 'article' AS selectors,
           false AS include_external, true AS include_subdomains, 2 AS max_depth, 100 AS max_pages, '' AS paths_to_skip_regex,
           CASE WHEN page_id % 3 = 0 THEN 'json' WHEN page_id % 4 = 0 THEN '' ELSE NULL END AS output_format,
           CASE WHEN page_id % 3 = 0 THEN 'json' ELSE 'markdown' END AS resolved_format,
           CASE WHEN starts_with(host, 'blog.') THEN 'file_per_domain' ELSE 'folder_per_domain' END AS persistence
    FROM specs
    UNION ALL
    SELECT page_id, 1, 'https://' || host || CASE WHEN part = 0 THEN '/sitemap.xml' ELSE '/sitemap-' || part || '.xml' END,
           true, false, 'article,main', false, true, 2, 50, '', NULL, 'markdown',
           CASE WHEN starts_with(host, 'blog.') THEN 'file_per_domain' ELSE 'folder_per_domain' END
    FROM specs WHERE lists
    UNION ALL
    SELECT page_id, CASE WHEN lists THEN 2 ELSE 1 END, seed, false, true, '', false, NOT starts_with(host, 'blog.'), 1, 100, '/(de|es)/', NULL, 'markdown',
           CASE WHEN starts_with(host, 'blog.') THEN 'file_per_domain' ELSE 'folder_per_domain' END
    FROM specs)"""

# what the sitemaps list is taken from the pages, not from the sitemap documents
_EXPANDED_SQL = f"""
  expanded AS (
    SELECT f.page_id AS spec_id, 1 AS pos, CAST(r.rn - f.rn AS BIGINT) AS sub, {S.normalize_url('r.url')} AS url,
           false AS is_sitemap, false AS should_scrap, 'article,main' AS selectors, 50 AS max_pages,
           true AS include_subdomains, CASE WHEN starts_with(f.host, 'blog.') THEN 'file_per_domain' ELSE 'folder_per_domain' END AS persistence
    FROM ranked_pages r JOIN specs f ON f.host = r.host AND f.lists AND f.part = (r.rn - 1) // {SITEMAP_MAX_LOCS}
    UNION ALL
    SELECT spec_id, pos, CAST(0 AS BIGINT), url, is_sitemap, should_scrap, selectors, max_pages, include_subdomains, persistence FROM items WHERE NOT is_sitemap)"""


@register(
    "job_spec_items",
    f"""WITH {_ITEMS_SQL} SELECT spec_id, CAST(pos AS INTEGER) AS pos, url, is_sitemap, should_scrap, selectors, include_external,
        include_subdomains, CAST(max_depth AS INTEGER) AS max_depth, CAST(max_pages AS INTEGER) AS max_pages, paths_to_skip_regex,
        output_format, persistence FROM items""",
    ("derived_seeds",),
)
def job_spec_items(spark, sf):
    d = job_spec_items_df(spark, sf)
    return d.select(
        "spec_id", "pos", "url", "is_sitemap", "should_scrap", F.array_join("selectors", ",").alias("selectors"),
        "include_external", "include_subdomains", "max_depth", "max_pages", "paths_to_skip_regex", "output_format", "persistence",
    )


@register(
    "item_output_format",
    f"WITH {_ITEMS_SQL} SELECT spec_id, CAST(pos AS INTEGER) AS pos, resolved_format FROM items",
    ("derived_seeds",),
)
def item_output_format(spark, sf):
    return job_spec_items_df(spark, sf).select("spec_id", "pos", "resolved_format")


@register(
    "split_flat_deep",
    f"""WITH {_ITEMS_SQL} SELECT spec_id, CAST(pos AS INTEGER) AS pos, CASE WHEN should_scrap THEN 'deep' ELSE 'flat' END AS kind FROM items""",
    ("derived_seeds",),
)
def split_flat_deep(spark, sf):
    d = job_spec_items_df(spark, sf)
    return d.select("spec_id", "pos", F.when(F.col("should_scrap"), F.lit("deep")).otherwise(F.lit("flat")).alias("kind"))


# ---------------------------------------------------------------- sitemaps

_LOCS_SQL = """locs AS (
    SELECT host, part, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS pos, replace(unnest(l), '&amp;', '&') AS loc
    FROM (SELECT host, part, regexp_extract_all(xml, '<loc>([^<]*)</loc>', 1) AS l FROM derived_sitemaps) t)"""


@register("sitemap_locs", f"WITH {_LOCS_SQL} SELECT host, part, pos, loc FROM locs", ("derived_sitemaps",))
def sitemap_locs(spark, sf):
    return SP.sitemap_locs(X.derived_sitemaps(spark, sf), keys=["host", "part"])


@register(
    "sitemap_counts",
    "SELECT host, part, CAST(len(regexp_extract_all(xml, '<loc>([^<]*)</loc>', 1)) AS BIGINT) AS locs FROM derived_sitemaps",
    ("derived_sitemaps",),
)
def sitemap_counts(spark, sf):
    """Locs per sitemap (0 = failed or empty)."""
    return X.derived_sitemaps(spark, sf).select("host", "part", SP.loc_count(F.col("xml")).alias("locs"))


SITEMAP_ITEM_COLS = ["spec_id", "pos", "sub", "url", "is_sitemap", "should_scrap", "selectors", "max_pages"]


def expanded_items(spark, sf, max_locs=SITEMAP_MAX_LOCS):
    """Items of every spec with its sitemap items expanded."""
    sm = X.derived_sitemaps(spark, sf, max_locs).withColumn("sitemap_url", X.sitemap_url(F.col("host"), F.col("part")))
    locs = SP.sitemap_locs(sm, keys=["sitemap_url"])
    return SP.expand_sitemaps(job_spec_items_df(spark, sf, max_locs), locs)


@register(
    "sitemap_items",
    f"""WITH {_ITEMS_SQL}, {_EXPANDED_SQL}
    SELECT spec_id, CAST(pos AS INTEGER) AS pos, sub, url, is_sitemap, should_scrap, selectors, CAST(max_pages AS INTEGER) AS max_pages FROM expanded""",
    ("derived_seeds",),
)
def sitemap_items(spark, sf):
    """J1 + P14 + F6 + U1: all items, sitemap items replaced by one item per
    listed URL.  The oracle takes the listed URLs from the pages."""
    out = expanded_items(spark, sf)
    return out.withColumn("selectors", F.array_join("selectors", ",")).select(*SITEMAP_ITEM_COLS)


# ------------------------------------------------------------------ dry run

@register(
    "crawl_plan",
    f"""WITH {_ITEMS_SQL}, {_EXPANDED_SQL},
    keyed AS (SELECT *, {S.normalize_url('url')} AS key FROM expanded),
    kept AS (SELECT * FROM keyed QUALIFY row_number() OVER (PARTITION BY spec_id, key ORDER BY pos, sub) = 1),
    plan AS (
      SELECT page_id AS spec_id, 'youtube' AS kind, 0 AS phase, 0 AS pos, CAST(0 AS BIGINT) AS sub,
             {S.normalize_url("'https://youtu.be/' || lpad(CAST(page_id AS VARCHAR), 11, 'a') || '#t'")} AS url
      FROM specs
      UNION ALL SELECT spec_id, 'flat', 1, pos, sub, url FROM kept WHERE NOT should_scrap
      UNION ALL SELECT spec_id, 'deep', 2, pos, sub, url FROM kept WHERE should_scrap)
    SELECT spec_id, kind, CAST(phase AS INTEGER) AS phase, CAST(pos AS INTEGER) AS pos, sub, url FROM plan""",
    ("derived_seeds",),
)
def crawl_plan(spark, sf):
    """P15 (dry run): what a run would process, after sitemap expansion
    and first-wins dedup (W1): videos, flat items, deep items in the order
    ``(phase, pos, sub)``; nothing is fetched."""
    items = SP.dedup_items(expanded_items(spark, sf), ["spec_id"])
    deep = F.col("should_scrap")
    listed = items.select(
        "spec_id", F.when(deep, "deep").otherwise("flat").alias("kind"), F.when(deep, 2).otherwise(1).alias("phase"), "pos", "sub", "url")
    vids = SP.spec_videos(SP.parse_spec_text(spec_documents(spark, sf)), ["spec_id"]).select(
        "spec_id", F.lit("youtube").alias("kind"), F.lit(0).alias("phase"), "pos", F.lit(0).cast("bigint").alias("sub"), "url")
    return vids.unionByName(listed)
