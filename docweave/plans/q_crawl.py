"""Registered queries: filters (F1-F5, F13), fetch join (K-S3/J2), statistics
(A1-A3, A7), links (H2) and the deep crawl (G1-G3, J3, J4, U3, U4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from docweave.functions import content as C
from docweave.functions import urls as U
from docweave.operators import crawl as G
from docweave.operators import filters as FL
from docweave.operators import stats as ST
from docweave.plans import sqlfrag as S
from docweave.plans.registry import register
from docweave.sources import fixtures as X
from docweave.sources.tables import pages

# ------------------------------------------------------------------ filters


def _items(spark, sf):
    return FL.with_item_checks(X.deep_items(spark, sf)).drop("url")


def _candidates(spark, sf):
    return X.filter_candidates(spark, sf).join(_items(spark, sf), "item_id")


_ITEMS_SQL = f"""items AS (
    SELECT *, url AS seed_url, nullif({S.domain('url')}, '') AS domain FROM deep_items),
  cand AS (SELECT c.item_id, c.src, c.variant, c.url, i.seed_url, i.domain, i.include_subdomains,
                  i.include_external, i.paths_to_skip_regex, i.max_depth, i.max_pages
           FROM filter_candidates c JOIN items i ON i.item_id = c.item_id)"""

_SKIP_SQL = "(paths_to_skip_regex = '' OR NOT regexp_matches(url, paths_to_skip_regex))"
_SUB_SQL = "coalesce(strpos(url, domain) > 0, false)"
_EXACT_SQL = "coalesce(regexp_matches(url, '^https?://(www\\.)?' || replace(domain, '.', '\\.')), false)"


def _external_sql(u: str, seed: str, inc: str) -> str:
    return f"coalesce({inc} OR {S.is_subdomain(u, seed)}, false)"


_CHAIN_SQL = f"({_SKIP_SQL} AND (CASE WHEN include_subdomains THEN {_SUB_SQL} ELSE {_EXACT_SQL} END) AND {_external_sql('url', 'seed_url', 'include_external')})"
_CAND_FIX = ("deep_items", "filter_candidates")


@register("filter_skip_regex", f"WITH {_ITEMS_SQL} SELECT item_id, src, variant, url FROM cand WHERE {_SKIP_SQL}", _CAND_FIX)
def filter_skip_regex(spark, sf):
    c = _candidates(spark, sf)
    return c.where(FL.skip_filter("url", "paths_to_skip_regex", "regex_valid")).select("item_id", "src", "variant", "url")


@register("filter_subdomains", f"WITH {_ITEMS_SQL} SELECT item_id, src, variant, url FROM cand WHERE {_SUB_SQL}", _CAND_FIX)
def filter_subdomains(spark, sf):
    c = _candidates(spark, sf)
    return c.where(FL.subdomain_filter("url", "domain")).select("item_id", "src", "variant", "url")


@register("filter_exact_domain", f"WITH {_ITEMS_SQL} SELECT item_id, src, variant, url FROM cand WHERE {_EXACT_SQL}", _CAND_FIX)
def filter_exact_domain(spark, sf):
    c = _candidates(spark, sf)
    return c.where(FL.exact_domain_filter("url", "domain")).select("item_id", "src", "variant", "url")


@register(
    "filter_chain",
    f"WITH {_ITEMS_SQL} SELECT item_id, src, variant, url, include_subdomains FROM cand WHERE {_CHAIN_SQL}",
    _CAND_FIX,
)
def filter_chain(spark, sf):
    c = _candidates(spark, sf)
    return c.where(FL.filter_chain(F.col("url"))).select("item_id", "src", "variant", "url", "include_subdomains")


# ------------------------------------------------------------ fetch results


def fetch_results(spark, sf):
    """K-S3/J2: requested URLs (every URL variant) joined to the captures by
    canonical URL, left outer: a URL with no capture is a failed fetch.
    Status follows F13 on the markdown of the capture."""
    req = X.url_variants(spark, sf).select("uid", "url", U.normalize_url("url").alias("key"))
    cap = G.first_capture(X.derived_fetch(spark, sf))
    j = req.join(cap, "key", "left")
    success = F.coalesce(F.col("fetched"), F.lit(False))
    return j.select("uid", "url", "key", success.alias("success"), G.capture_status(success).alias("status"))


_FIRST_CAPTURE_SQL = f"""cap AS (
    SELECT key, page_id, success, html FROM (SELECT *, {S.normalize_url('url')} AS key FROM derived_fetch) t
    QUALIFY row_number() OVER (PARTITION BY key ORDER BY success DESC, page_id) = 1)"""

_FETCH_SQL = f"""{_FIRST_CAPTURE_SQL},
  req AS (SELECT uid, url, {S.normalize_url('url')} AS key FROM url_variants),
  res AS (SELECT req.uid, req.url, req.key, coalesce(cap.success, false) AS success,
                 CASE WHEN NOT coalesce(cap.success, false) THEN 'failed'
                      WHEN NOT {S.nonblank(S.html_to_markdown('cap.html'))} THEN 'skipped' ELSE 'success' END AS status
          FROM req LEFT JOIN cap ON cap.key = req.key)"""


@register(
    "page_fetch_results",
    f"WITH {_FETCH_SQL} SELECT uid, url, key, success, status FROM res",
    ("url_variants", "derived_fetch"),
)
def page_fetch_results(spark, sf):
    return fetch_results(spark, sf)


@register(
    "fetch_status",
    f"""SELECT page_id, url, success,
        CASE WHEN NOT success THEN 'failed' WHEN NOT {S.nonblank(S.html_to_markdown('html'))} THEN 'skipped' ELSE 'success' END AS status
        FROM derived_fetch""",
    ("derived_fetch",),
)
def fetch_status(spark, sf):
    f = X.derived_fetch(spark, sf)
    return f.select("page_id", "url", "success", FL.fetch_status(F.col("success"), C.html_to_markdown(F.col("html"))).alias("status"))


@register(
    "batch_stats",
    f"""WITH {_FETCH_SQL} SELECT count(*) AS total, CAST(count_if(status = 'success') AS BIGINT) AS success,
        CAST(count_if(status = 'failed') AS BIGINT) AS failed, CAST(count_if(status = 'skipped') AS BIGINT) AS skipped FROM res""",
    ("url_variants", "derived_fetch"),
)
def batch_stats(spark, sf):
    return ST.batch_stats(fetch_results(spark, sf))


@register(
    "run_summary",
    f"""WITH {_FETCH_SQL}
    SELECT 'requested' AS stage, count(*) AS rows FROM res
    UNION ALL SELECT 'unique_keys', count(DISTINCT key) FROM res
    UNION ALL SELECT 'fetched', count(*) FROM res WHERE success
    UNION ALL SELECT 'saved', count(*) FROM res WHERE status = 'success'""",
    ("url_variants", "derived_fetch"),
)
def run_summary(spark, sf):
    r = fetch_results(spark, sf)
    return ST.run_summary(
        r,
        {
            "requested": F.count(F.lit(1)),
            "unique_keys": F.count_distinct("key"),
            "fetched": F.count_if("success"),
            "saved": F.count_if(F.col("status") == "success"),
        },
    )


# -------------------------------------------------------------------- links


def _resolve_sql(base: str, href: str) -> str:
    """SQL form of :func:`docweave.functions.content.resolve_link`."""
    ref = f"trim(replace({href}, '&amp;', '&'))"

    def with_ref(r):
        scheme = f"lower(regexp_extract({base}, '^([A-Za-z][A-Za-z0-9+.-]*):', 1))"
        auth = f"regexp_extract({base}, '^[A-Za-z][A-Za-z0-9+.-]*:(//[^/?#]*)', 1)"
        bnf = f"split_part({base}, '#', 1)"
        bpath = f"regexp_extract({bnf}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?]*)', 1)"
        bquery = f"regexp_extract({bnf}, '(\\?.*)$', 1)"
        nofrag = f"split_part({r}, '#', 1)"
        frag = f"CASE WHEN strpos({r}, '#') > 0 THEN substr({r}, strpos({r}, '#')) ELSE '' END"
        rpath = f"CASE WHEN strpos({nofrag}, '?') > 0 THEN substr({nofrag}, 1, strpos({nofrag}, '?') - 1) ELSE {nofrag} END"
        rquery = f"CASE WHEN strpos({nofrag}, '?') > 0 THEN substr({nofrag}, strpos({nofrag}, '?')) ELSE '' END"

        def dots(segs: str) -> str:
            a, s = S.fresh("a"), S.fresh("s")
            red = (
                f"list_reduce(list_prepend([]::VARCHAR[], list_transform({segs}, lambda {s}: [{s}])), "
                f"lambda {a}, {s}: CASE WHEN {s}[1] = '..' THEN (CASE WHEN len({a}) > 0 THEN {a}[1:len({a}) - 1] ELSE {a} END) "
                f"WHEN {s}[1] = '.' THEN {a} ELSE list_concat({a}, {s}) END)"
            )
            red = f"(CASE WHEN list_last({segs}) IN ('.', '..') THEN list_concat({red}, ['']) ELSE {red} END)"
            return S.let(
                f"array_to_string({red}, '/')",
                lambda j: f"(CASE WHEN {j} = '' THEN '/' WHEN starts_with({j}, '/') THEN {j} ELSE '/' || {j} END)",
            )

        def rel_segments(bp: str, rp: str) -> str:
            bd = f"string_split({bp}, '/')"
            bd = f"(CASE WHEN list_last({bd}) <> '' THEN {bd}[1:len({bd}) - 1] ELSE {bd} END)"
            allseg = f"list_concat({bd}, string_split({rp}, '/'))"
            x = S.fresh("x")
            return S.let(
                allseg,
                lambda v: f"(CASE WHEN len({v}) > 2 THEN list_concat(list_concat({v}[1:1], list_filter({v}[2:len({v}) - 1], lambda {x}: {x} <> '')), {v}[len({v}):len({v})]) ELSE {v} END)",
            )

        prefix = f"({scheme} || ':' || {auth})"
        return (
            f"CASE WHEN regexp_matches({r}, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN {r} "
            f"WHEN starts_with({r}, '//') THEN {scheme} || ':' || {r} "
            f"WHEN starts_with({rpath}, '/') THEN {prefix} || {dots(f'string_split({rpath}, chr(47))')} || {rquery} || {frag} "
            f"WHEN {rpath} = '' THEN {prefix} || {bpath} || (CASE WHEN {rquery} <> '' THEN {rquery} ELSE {bquery} END) || {frag} "
            f"ELSE {prefix} || {dots(rel_segments(bpath, rpath))} || {rquery} || {frag} END"
        )

    return S.let(ref, with_ref)


@register(
    "page_links",
    f"""WITH h AS (SELECT page_id, url AS page_url, {S.hrefs('html')} AS hs FROM pages),
    e AS (SELECT page_id, page_url, CAST(generate_subscripts(hs, 1) - 1 AS INTEGER) AS pos, unnest(hs) AS href FROM h),
    r AS (SELECT page_id, pos, href, {S.normalize_url(_resolve_sql('page_url', 'href'))} AS link FROM e)
    SELECT page_id, pos, href, link FROM r WHERE regexp_matches(link, '^(?i)https?://')""",
)
def page_links(spark, sf):
    return C.page_links(pages(spark, sf)).select("page_id", "pos", "href", "link")


# --------------------------------------------------------------- deep crawl


def crawl_inputs(spark, sf):
    items = _items(spark, sf)
    edges = G.canonical_edges(X.derived_links(spark, sf))
    fetch = G.canonical_fetch(X.derived_fetch(spark, sf))
    return items, edges, fetch


def crawl_results(spark, sf, order="best_first"):
    """G1 + status: every reported page with its fetch status (F13 over the
    markdown of the first capture of its canonical URL)."""
    items, edges, fetch = crawl_inputs(spark, sf)
    pages_out = G.deep_crawl(items, edges, fetch, order=order)
    cap = G.first_capture(X.derived_fetch(spark, sf)).select(F.col("key").alias("url"), "nonblank")
    return pages_out.join(cap, "url", "left").select(
        "item_id", "url", "depth", "success", G.capture_status(F.col("success")).alias("status"), F.lit(0.0).alias("score")
    )


_CRAWL_SQL = f"""
  items AS (SELECT *, url AS seed_url, nullif({S.domain('url')}, '') AS domain FROM deep_items),
  edges AS (SELECT DISTINCT {S.normalize_url('src')} AS src, {S.normalize_url('dst')} AS dst FROM derived_links),
  fetched AS (SELECT {S.normalize_url('url')} AS url, bool_or(success) AS success FROM derived_fetch GROUP BY 1),
  walk(item_id, url, depth) AS (
    SELECT item_id, {S.normalize_url('seed_url')}, 0 FROM items WHERE domain IS NOT NULL
    UNION
    SELECT w.item_id, e.dst, w.depth + 1
    FROM walk w JOIN fetched f ON f.url = w.url AND f.success
    JOIN edges e ON e.src = w.url
    JOIN items i ON i.item_id = w.item_id
    WHERE w.depth + 1 <= i.max_depth AND (
      ({_SKIP_SQL.replace('url', 'e.dst').replace('paths_to_skip_regex', 'i.paths_to_skip_regex')})
      AND (CASE WHEN i.include_subdomains THEN coalesce(strpos(e.dst, i.domain) > 0, false)
           ELSE coalesce(regexp_matches(e.dst, '^https?://(www\\.)?' || replace(i.domain, '.', '\\.')), false) END)
      AND {_external_sql('e.dst', 'i.seed_url', 'i.include_external')})),
  firsts AS (SELECT item_id, url, min(depth) AS depth FROM walk GROUP BY 1, 2),
  st AS (SELECT f.item_id, f.url, f.depth, coalesce(x.success, false) AS success FROM firsts f LEFT JOIN fetched x ON x.url = f.url),
  ranked AS (SELECT st.*, i.max_pages, coalesce(sum(CASE WHEN st.success THEN 1 ELSE 0 END) OVER (
                PARTITION BY st.item_id ORDER BY st.depth, st.url ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
             FROM st JOIN items i ON i.item_id = st.item_id),
  crawl AS (SELECT item_id, url, depth, success FROM ranked WHERE before < max_pages),
  {_FIRST_CAPTURE_SQL},
  results AS (SELECT c.item_id, c.url, c.depth, c.success,
                CASE WHEN NOT c.success THEN 'failed' WHEN NOT {S.nonblank(S.html_to_markdown('cap.html'))} THEN 'skipped' ELSE 'success' END AS status
              FROM crawl c LEFT JOIN cap ON cap.key = c.url)"""
_CRAWL_FIX = ("deep_items", "derived_links", "derived_fetch")


@register("deep_crawl", f"WITH RECURSIVE {_CRAWL_SQL} SELECT item_id, url, CAST(depth AS INTEGER) AS depth, success FROM crawl", _CRAWL_FIX)
def deep_crawl(spark, sf):
    items, edges, fetch = crawl_inputs(spark, sf)
    return G.deep_crawl(items, edges, fetch).select("item_id", "url", F.col("depth").cast("int").alias("depth"), "success")


@register(
    "bfs_levels",
    f"WITH RECURSIVE {_CRAWL_SQL} SELECT CAST(depth AS INTEGER) AS depth, count(*) AS pages, CAST(count_if(success) AS BIGINT) AS fetched FROM crawl GROUP BY 1",
    _CRAWL_FIX,
)
def bfs_levels(spark, sf):
    items, edges, fetch = crawl_inputs(spark, sf)
    c = G.deep_crawl(items, edges, fetch, order="bfs")
    return c.groupBy(F.col("depth").cast("int").alias("depth")).agg(
        F.count(F.lit(1)).alias("pages"), F.sum(F.col("success").cast("bigint")).alias("fetched")
    )


@register(
    "deep_crawl_stats",
    f"""WITH RECURSIVE {_CRAWL_SQL}
    SELECT item_id, count(*) AS total_pages, CAST(count_if(status = 'success') AS BIGINT) AS success,
      CAST(count_if(status = 'failed') AS BIGINT) AS failed, CAST(count_if(status = 'skipped') AS BIGINT) AS skipped,
      CAST(coalesce(max(depth) FILTER (WHERE status = 'success'), 0) AS BIGINT) AS max_depth_reached,
      coalesce(avg(0.0::DOUBLE) FILTER (WHERE status = 'success'), 0.0) AS avg_score
    FROM results GROUP BY item_id""",
    _CRAWL_FIX,
)
def deep_crawl_stats(spark, sf):
    return ST.deep_crawl_stats(crawl_results(spark, sf))


def link_score(url):
    """Score of a URL for the scored crawl: a fixed fraction from its hash."""
    return F.conv(F.md5(url).substr(1, 4), 16, 10).cast("int") / F.lit(65536.0)


SCORE_BATCH = 2
#: An item of the fixture reaches at most the seven pages of its tree within depth 2.
SCORE_ROUNDS = 7
_SCORE_SQL = "(CAST('0x' || left(md5({0}), 4) AS INTEGER) / 65536.0)"


def _rounds_sql() -> str:
    """Rounds of the scored crawl, written out: frontier f0, visited v0, frontier f1, ..."""
    s = [f"""fetched AS MATERIALIZED (SELECT {S.normalize_url('url')} AS url, bool_or(success) AS success FROM derived_fetch GROUP BY 1),
  items AS MATERIALIZED (SELECT *, url AS seed_url, nullif({S.domain('url')}, '') AS domain FROM deep_items),
  edges AS MATERIALIZED (SELECT DISTINCT {S.normalize_url('src')} AS src, {S.normalize_url('dst')} AS dst FROM derived_links),
  f0 AS MATERIALIZED (SELECT DISTINCT item_id, {S.normalize_url('seed_url')} AS url, 0 AS depth FROM items WHERE domain IS NOT NULL)"""]
    for r in range(SCORE_ROUNDS):
        seen = " UNION ALL ".join(f"SELECT item_id, url, success FROM v{k}" for k in range(r)) or "SELECT item_id, url, false AS success FROM f0 WHERE false"
        s.append(f"""v{r} AS MATERIALIZED (
    SELECT item_id, url, depth, success, score, {r} AS round FROM (
      SELECT t.*, max_pages - spent AS left_, coalesce(sum(success::INT) OVER (PARTITION BY item_id ORDER BY score DESC, depth, url ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM (
        SELECT f.item_id, f.url, f.depth, coalesce(x.success, false) AS success, {_SCORE_SQL.format('f.url')} AS score, i.max_pages, coalesce(p.n, 0) AS spent
        FROM f{r} f JOIN items i ON i.item_id = f.item_id LEFT JOIN fetched x ON x.url = f.url
        LEFT JOIN (SELECT item_id, count(*) AS n FROM ({seen}) WHERE success GROUP BY 1) p ON p.item_id = f.item_id
        WHERE i.max_pages > coalesce(p.n, 0)
        QUALIFY row_number() OVER (PARTITION BY f.item_id ORDER BY score DESC, f.depth, f.url) <= {SCORE_BATCH}) t)
    WHERE before < left_)""")
        s.append(f"""f{r + 1} AS MATERIALIZED (
    SELECT item_id, url, min(depth) AS depth FROM (
      SELECT item_id, url, depth FROM f{r}
      UNION ALL
      SELECT w.item_id, e.dst, w.depth + 1 FROM v{r} w JOIN edges e ON e.src = w.url JOIN items i ON i.item_id = w.item_id
      WHERE w.success AND w.depth + 1 <= i.max_depth AND {_followed_sql('e.dst')})
    WHERE (item_id, url) NOT IN (SELECT (item_id, url) FROM ({seen} UNION ALL SELECT item_id, url, success FROM v{r}))
    GROUP BY 1, 2)""")
    visited = " UNION ALL ".join(f"SELECT * FROM v{r}" for r in range(SCORE_ROUNDS))
    return ",\n  ".join(s) + f",\n  visited AS ({visited})"


def _followed_sql(u: str) -> str:
    """Item filters (alias ``i``) on a link."""
    skip = _SKIP_SQL.replace("url", u).replace("paths_to_skip_regex", "i.paths_to_skip_regex")
    return f"""{skip} AND (CASE WHEN i.include_subdomains THEN coalesce(strpos({u}, i.domain) > 0, false)
           ELSE coalesce(regexp_matches({u}, '^https?://(www\\.)?' || replace(i.domain, '.', '\\.')), false) END)
      AND {_external_sql(u, 'i.seed_url', 'i.include_external')}"""


_SCORED_SQL = _rounds_sql()


def scored_crawl(spark, sf):
    items, edges, fetch = crawl_inputs(spark, sf)
    return G.deep_crawl(items, edges, fetch, score=link_score, batch=SCORE_BATCH)


@register(
    "deep_crawl_scored",
    f"WITH {_SCORED_SQL} SELECT item_id, url, CAST(depth AS INTEGER) AS depth, success, score, CAST(round AS INTEGER) AS round FROM visited",
    _CRAWL_FIX,
)
def deep_crawl_scored(spark, sf):
    """G1 + X3 with a caller's score: two pages of each item a round, best first."""
    return scored_crawl(spark, sf)


@register(
    "deep_crawl_scored_stats",
    f"""WITH {_SCORED_SQL}, {_FIRST_CAPTURE_SQL},
    results AS (SELECT v.*, CASE WHEN NOT v.success THEN 'failed' WHEN NOT {S.nonblank(S.html_to_markdown('cap.html'))} THEN 'skipped' ELSE 'success' END AS status
                FROM visited v LEFT JOIN cap ON cap.key = v.url)
    SELECT item_id, count(*) AS total_pages, CAST(count_if(status = 'success') AS BIGINT) AS success,
      CAST(count_if(status = 'failed') AS BIGINT) AS failed, CAST(count_if(status = 'skipped') AS BIGINT) AS skipped,
      CAST(coalesce(max(depth) FILTER (WHERE status = 'success'), 0) AS BIGINT) AS max_depth_reached,
      round(coalesce(avg(score) FILTER (WHERE status = 'success'), 0.0), 9) AS avg_score
    FROM results GROUP BY item_id""",
    _CRAWL_FIX,
)
def deep_crawl_scored_stats(spark, sf):
    """A2 over the scored crawl: the mean score is that of real links."""
    cap = G.first_capture(X.derived_fetch(spark, sf)).select(F.col("key").alias("url"), "nonblank")
    results = scored_crawl(spark, sf).join(cap, "url", "left").withColumn("status", G.capture_status(F.col("success")))
    return ST.deep_crawl_stats(results).withColumn("avg_score", F.round("avg_score", 9))


@register(
    "page_link_crawl",
    f"""WITH RECURSIVE h AS (SELECT url AS page_url, {S.hrefs('html')} AS hs FROM derived_pages),
  l AS (SELECT page_url, {S.normalize_url(_resolve_sql('page_url', 'href'))} AS link FROM (SELECT page_url, unnest(hs) AS href FROM h)),
  found_links AS (SELECT page_url AS src, link AS dst FROM l WHERE regexp_matches(link, '^(?i)https?://')),
  {_CRAWL_SQL.replace('derived_links', 'found_links')} SELECT item_id, url, CAST(depth AS INTEGER) AS depth, success FROM crawl""",
    ("deep_items", "derived_pages", "derived_fetch"),
)
def page_link_crawl(spark, sf):
    """H2 + J3 + G1: a crawl over the links extracted from captured pages."""
    items, _, fetch = crawl_inputs(spark, sf)
    links = C.page_links(X.derived_pages(spark, sf))
    edges = G.canonical_edges(links, "page_url", "link")
    return G.deep_crawl(items, edges, fetch).select("item_id", "url", F.col("depth").cast("int").alias("depth"), "success")


@register(
    "depth_distribution",
    f"""WITH RECURSIVE {_CRAWL_SQL}
    SELECT item_id, 'depth_' || CAST(depth AS VARCHAR) AS depth_key, count(*) AS pages FROM results WHERE status = 'success' GROUP BY 1, 2""",
    _CRAWL_FIX,
)
def depth_distribution(spark, sf):
    return ST.depth_distribution(crawl_results(spark, sf))


@register(
    "run_urls",
    f"""WITH RECURSIVE {_CRAWL_SQL}
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY depth, url) AS BIGINT) AS position, url FROM crawl""",
    _CRAWL_FIX,
)
def run_urls(spark, sf):
    items, edges, fetch = crawl_inputs(spark, sf)
    return ST.run_urls(G.deep_crawl(items, edges, fetch))


@register(
    "visited_after_run",
    f"WITH RECURSIVE {_CRAWL_SQL} SELECT DISTINCT url AS norm_url FROM crawl",
    _CRAWL_FIX,
)
def visited_after_run(spark, sf):
    items, edges, fetch = crawl_inputs(spark, sf)
    c = G.deep_crawl(items, edges, fetch).select(F.col("url").alias("norm_url"))
    return G.visited_set(c)


@register(
    "unvisited_urls",
    f"""WITH RECURSIVE {_CRAWL_SQL},
    cand AS (SELECT uid, url, {S.normalize_url('url')} AS norm_url FROM url_variants)
    SELECT uid, url, norm_url FROM cand WHERE norm_url NOT IN (SELECT url FROM crawl)""",
    _CRAWL_FIX + ("url_variants",),
)
def unvisited_urls(spark, sf):
    items, edges, fetch = crawl_inputs(spark, sf)
    visited = G.deep_crawl(items, edges, fetch).select(F.col("url").alias("norm_url"))
    cand = X.url_variants(spark, sf).select("uid", "url", U.normalize_url("url").alias("norm_url"))
    return G.unvisited(cand, visited)
