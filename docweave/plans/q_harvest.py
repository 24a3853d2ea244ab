"""Registered queries: whole runs from spec to sink (K-S1 to K5, W1, W7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from docweave.constants import UNKNOWN_DOMAIN, VIDEO_ID_PATTERN
from docweave.functions.content import once
from docweave.functions.paths import document_path
from docweave.functions.urls import extract_domain
from docweave.operators import crawl as G
from docweave.operators import harvest as R
from docweave.operators.windows import ordinal_within
from docweave.plans import sqlfrag as S
from docweave.plans.q_crawl import _FIRST_CAPTURE_SQL, _external_sql
from docweave.plans.q_functions import _TRANSCRIPTS_SQL, _clean_sql, transcripts
from docweave.plans.q_spec import _EXPANDED_SQL, _ITEMS_SQL, expanded_items, spec_documents
from docweave.plans.registry import register
from docweave.sources import fixtures as X
from docweave.sources import spec as SP


def harvest_saves(spark, sf, measure=None):
    """All saves of every spec: expand, de-duplicate, split, fetch or crawl,
    transcripts, one order."""
    items = SP.dedup_items(expanded_items(spark, sf), ["spec_id"])
    spec = SP.spec_settings(SP.parse_spec_text(spec_documents(spark, sf)))
    videos = SP.spec_videos(spec, ["spec_id", "persistence"])
    fetch = X.derived_fetch(spark, sf)
    edges = G.canonical_edges(X.derived_links(spark, sf))
    return R.harvest(items, videos, fetch, edges, transcripts(spark, sf), measure)


_DOMAIN = "coalesce(nullif({0}, ''), 'unknown')"

_HARVEST_SQL = f"""{_ITEMS_SQL}, {_EXPANDED_SQL},
  keyed AS (SELECT *, {S.normalize_url('url')} AS key FROM expanded),
  kept AS (SELECT * FROM keyed QUALIFY row_number() OVER (PARTITION BY spec_id, key ORDER BY pos, sub) = 1),
  edges AS (SELECT DISTINCT {S.normalize_url('src')} AS src, {S.normalize_url('dst')} AS dst FROM derived_links),
  fetched AS (SELECT {S.normalize_url('url')} AS url, bool_or(success) AS success FROM derived_fetch GROUP BY 1),
  {_FIRST_CAPTURE_SQL},
  seeds AS (SELECT *, nullif({S.domain('url')}, '') AS domain FROM kept WHERE should_scrap),
  reached AS (
    SELECT spec_id, persistence, pos, sub, 0 AS depth, key AS url FROM seeds WHERE domain IS NOT NULL
    UNION
    SELECT s.spec_id, s.persistence, s.pos, s.sub, 1, e.dst
    FROM seeds s JOIN fetched f ON f.url = s.key AND f.success JOIN edges e ON e.src = s.key AND e.dst <> s.key
    WHERE NOT regexp_matches(e.dst, '/(de|es)/') AND {_external_sql('e.dst', 's.url', 'false')} AND s.domain IS NOT NULL
      AND CASE WHEN s.include_subdomains THEN strpos(e.dst, s.domain) > 0
               ELSE regexp_matches(e.dst, '^https?://(www\\.)?' || replace(s.domain, '.', '\\.')) END),
  {_TRANSCRIPTS_SQL},
  vids AS (SELECT page_id AS spec_id, CASE WHEN starts_with(host, 'blog.') THEN 'file_per_domain' ELSE 'folder_per_domain' END AS persistence,
                  {S.normalize_url("'https://youtu.be/' || lpad(CAST(page_id AS VARCHAR), 11, 'a') || '#t'")} AS source FROM specs),
  spoken AS (SELECT video_id, {_clean_sql('transcript')} AS text FROM transcripts),
  all_saves AS (
    SELECT spec_id, persistence, 0 AS phase, 0 AS pos, CAST(0 AS BIGINT) AS sub, 0 AS depth,
           'https://www.youtube.com/watch?v=' || video_id AS url,
           '# YouTube Transcript: ' || video_id || chr(10) || chr(10) || '**URL:** ' || source || chr(10) || chr(10) || text AS content
    FROM (SELECT *, nullif(regexp_extract(source, {S.q(VIDEO_ID_PATTERN)}, 1), '') AS vid FROM vids) v
    JOIN spoken ON spoken.video_id = v.vid WHERE text <> ''
    UNION ALL
    SELECT k.spec_id, k.persistence, 1, k.pos, k.sub, 0, k.url, {S.html_to_markdown('cap.html', 'article')}
    FROM kept k JOIN cap ON cap.key = k.key AND cap.success WHERE NOT k.should_scrap
    UNION ALL
    SELECT r.spec_id, r.persistence, 2, r.pos, r.sub, r.depth, r.url, {S.html_to_markdown('cap.html')}
    FROM reached r JOIN fetched f ON f.url = r.url AND f.success JOIN cap ON cap.key = r.url),
  harvested AS (
    SELECT *, {_DOMAIN.format(S.domain('url'))} AS domain, CAST(length(content) AS BIGINT) AS size,
           row_number() OVER (PARTITION BY spec_id ORDER BY phase, pos, sub, depth, url) AS ord
    FROM all_saves WHERE {S.nonblank('content')})"""
_HARVEST_FIX = ("derived_seeds", "derived_links", "derived_fetch", "derived_captions")


def _size(content):
    return F.length(content).cast("bigint")


def _domain():
    return F.coalesce(F.nullif(extract_domain(F.col("url")), F.lit("")), F.lit(UNKNOWN_DOMAIN))


@register(
    "harvest_manifest",
    f"""WITH {_HARVEST_SQL},
    filed AS (SELECT *, CASE WHEN persistence = 'file_per_domain' THEN 'out/' || domain || '.md' ELSE {S.document_path('out', 'url')} END AS path
              FROM harvested)
    SELECT spec_id, persistence, path, count(*) AS saves,
           CAST(CASE WHEN persistence = 'file_per_domain' THEN sum(size) ELSE arg_max(size, ord) END AS BIGINT) AS size,
           arg_min(url, ord) AS first_url, arg_max(url, ord) AS last_url
    FROM filed GROUP BY spec_id, persistence, path""",
    _HARVEST_FIX,
)
def harvest_manifest(spark, sf):
    """What each spec's sink (K5) holds after its run: one row per file with
    its saves and characters; the last save of a path wins (W6), a domain file
    holds all of its pages.  Many specs save one URL: its path is made once."""
    saves = harvest_saves(spark, sf, _size).select("spec_id", "persistence", "ord", "url", F.col("content").alias("size"))
    saves = saves.checkpoint(eager=True)
    merged = F.col("persistence") == "file_per_domain"
    path = F.when(merged, F.concat(F.lit("out/"), _domain(), F.lit(".md"))).otherwise(document_path("out", F.col("url")))
    paths = saves.select("persistence", "url").distinct().withColumn("path", once(path)).toDF("p", "u", "path")
    named = saves.join(paths, F.col("persistence").eqNullSafe(F.col("p")) & F.col("url").eqNullSafe(F.col("u")))
    files = named.groupBy("spec_id", "persistence", "path")
    return files.agg(
        F.count(F.lit(1)).alias("saves"), F.sum("size").alias("all"), F.max_by("size", "ord").alias("last"),
        F.min_by("url", "ord").alias("first_url"), F.max_by("url", "ord").alias("last_url"),
    ).select("spec_id", "persistence", "path", "saves", F.when(merged, F.col("all")).otherwise(F.col("last")).alias("size"), "first_url", "last_url")


@register(
    "harvest_page_order",
    f"""WITH {_HARVEST_SQL}
    SELECT spec_id, domain, CAST(row_number() OVER (PARTITION BY spec_id, domain ORDER BY ord) AS BIGINT) AS page_no,
           CAST(phase AS INTEGER) AS phase, url, size
    FROM harvested""",
    _HARVEST_FIX,
)
def harvest_page_order(spark, sf):
    """W7 over the order of a run: (phase, item, place in the sitemap, depth, url)."""
    saves = harvest_saves(spark, sf, _size).select(
        "spec_id", _domain().alias("domain"), "ord", "phase", "url", F.col("content").alias("size"))
    return ordinal_within(saves, ["spec_id", "domain"], "ord", "page_no").drop("ord")
