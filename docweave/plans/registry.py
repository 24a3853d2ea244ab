"""Registry of named queries: a Spark builder ``(spark, sf_dir) -> DataFrame``
and, where SQL can express it, the equivalent DuckDB oracle query.

Oracle queries see the driver tables as views; the derived fixtures of
FIXTURES.md are prepended as CTEs on demand.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docweave.constants import SITEMAP_MAX_LOCS
from docweave.plans.sqlfrag import q
from docweave.sources.fixtures import URL_VARIANT_SUFFIXES

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}

HOST_SQL = "regexp_extract(url, '^https?://([^/?#]+)', 1)"

_variants = ", ".join(f"({k}, {q(s)})" for k, s in URL_VARIANT_SUFFIXES)

# name -> (dependencies, SELECT body)
FIXTURE_SQL: dict[str, tuple[list[str], str]] = {
    "url_variants": ([], f"""
        SELECT page_id * 8 + v.k AS uid, v.k AS variant,
               concat(regexp_replace(url, '[?#].*$', ''), v.sfx) AS url
        FROM pages CROSS JOIN (VALUES {_variants}) AS v(k, sfx)"""),
    "ranked_pages": ([], f"""
        SELECT page_id, url, {HOST_SQL} AS host,
               row_number() OVER (PARTITION BY {HOST_SQL} ORDER BY page_id) AS rn
        FROM pages"""),
    "derived_links": (["ranked_pages"], """
        SELECT a.url AS src, b.url AS dst FROM ranked_pages a JOIN ranked_pages b
          ON a.host = b.host AND (b.rn = 2 * a.rn OR b.rn = 2 * a.rn + 1 OR (b.rn = 1 AND a.rn > 1))"""),
    "derived_pages": (["derived_links"], """
        SELECT page_id, p.url, html || coalesce(a.anchors, '') AS html FROM pages p LEFT JOIN (
          SELECT src AS url, array_to_string(list_sort(list('<a href="' || CASE WHEN starts_with(regexp_replace(dst, '^https?://[^/?#]+', ''), '/')
                   THEN regexp_replace(dst, '^https?://[^/?#]+', '') ELSE dst END || '">more</a>')), ' ') AS anchors
          FROM derived_links GROUP BY src) a ON a.url = p.url"""),
    "derived_seeds": (["ranked_pages"], "SELECT host, url FROM ranked_pages WHERE rn = 1"),
    "derived_fetch": ([], """
        SELECT page_id, url, CASE WHEN page_id % 17 = 0 THEN false ELSE true END AS success,
               CASE WHEN page_id % 13 = 0 THEN ' ' ELSE html END AS html FROM pages"""),
    "derived_videos": ([], """
        SELECT DISTINCT conv_id, CASE CAST(conv_id % 5 AS INT)
          WHEN 0 THEN concat('https://www.youtube.com/watch?v=', lpad(CAST(conv_id AS VARCHAR), 11, 'a'))
          WHEN 1 THEN concat('https://youtu.be/', lpad(CAST(conv_id AS VARCHAR), 11, 'a'))
          WHEN 2 THEN concat('https://www.youtube.com/embed/', lpad(CAST(conv_id AS VARCHAR), 11, 'a'))
          WHEN 3 THEN concat('https://www.youtube.com/watch?t=9&v=', lpad(CAST(conv_id AS VARCHAR), 11, 'a'))
          ELSE 'https://www.youtube.com/watch?v=invalid123' END AS url FROM conversations"""),
    "derived_captions": ([], """
        SELECT lpad(CAST(conv_id AS VARCHAR), 11, 'a') AS video_id, turn AS seq,
               CASE WHEN conv_id % 7 = 0 THEN 'de' ELSE 'en' END AS lang,
               role <> 'system' AS is_generated,
               concat('[0:00:', CAST(turn AS VARCHAR), ']<spk>', text) AS text FROM conversations"""),
    "derived_sitemaps": (["ranked_pages"], f"""
        SELECT host, CAST((rn - 1) // {SITEMAP_MAX_LOCS} AS BIGINT) AS part,
               concat('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">',
                      string_agg(concat('<url><loc>', replace(url, '&', '&amp;'), '</loc></url>'), '' ORDER BY page_id),
                      '</urlset>') AS xml
        FROM ranked_pages GROUP BY 1, 2"""),
    "deep_items": (["derived_seeds"], """
        SELECT host AS item_id, url,
               NOT starts_with(host, 'm.') AS include_subdomains,
               false AS include_external,
               2 AS max_depth,
               CASE WHEN starts_with(host, 'blog.') THEN 3 ELSE 100 END AS max_pages,
               CASE WHEN starts_with(host, 'www.') THEN '/(de|es)/' ELSE '' END AS paths_to_skip_regex
        FROM derived_seeds"""),
    "filter_candidates": (["derived_links"], f"""
        SELECT {HOST_SQL.replace('url', 'src')} AS item_id, src, v.k AS variant,
               CASE v.k WHEN 0 THEN dst
                        WHEN 1 THEN regexp_replace(dst, '^(https?://)([^/?#]+)', '\\1\\2.evil.example')
                        WHEN 2 THEN regexp_replace(dst, '^(https?://)([^/?#]+)', '\\1other.example.org')
                        ELSE regexp_replace(dst, '^(https?://)(?:www\\.)?([^/?#]+)', '\\1docs.\\2') END AS url
        FROM derived_links CROSS JOIN (VALUES (0), (1), (2), (3)) AS v(k)"""),
}


def with_fixtures(sql: str, *names: str) -> str:
    """Prepend the named fixtures (and their dependencies) as CTEs."""
    order: list[str] = []

    def visit(n: str):
        if n in order:
            return
        for d in FIXTURE_SQL[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return sql
    ctes = ",\n".join(f"{n} AS ({FIXTURE_SQL[n][1]})" for n in order)
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def register(name: str, sql: str | None = None, fixtures: tuple[str, ...] = ()):
    """Decorator: register a Spark builder and, optionally, its oracle SQL."""

    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_fixtures(sql, *fixtures)
        return fn

    return deco
