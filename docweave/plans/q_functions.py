"""Registered queries for the scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from docweave.constants import VIDEO_ID_PATTERN
from docweave.functions import content as C
from docweave.functions import paths as P
from docweave.functions import transcripts as T
from docweave.functions import urls as U
from docweave.plans import sqlfrag as S
from docweave.plans.registry import register
from docweave.sources import fixtures as X
from docweave.sources.tables import documents, pages

# ------------------------------------------------------------------ URLs


@register("url_normalize", f"SELECT uid, url, {S.normalize_url('url')} AS norm_url FROM url_variants", ("url_variants",))
def url_normalize(spark, sf):
    return X.url_variants(spark, sf).select("uid", "url", U.normalize_url("url").alias("norm_url"))


@register("url_cleanup", f"SELECT uid, url, {S.cleanup_url('url')} AS clean_url FROM url_variants", ("url_variants",))
def url_cleanup(spark, sf):
    return X.url_variants(spark, sf).select("uid", "url", U.cleanup_url("url").alias("clean_url"))


@register("url_domain", f"SELECT uid, {S.domain('url')} AS domain FROM url_variants", ("url_variants",))
def url_domain(spark, sf):
    return X.url_variants(spark, sf).select("uid", U.extract_domain("url").alias("domain"))


def _neighbour_pairs(spark, sf):
    p = pages(spark, sf).select("page_id", "url")
    nxt = p.select((F.col("page_id") - 1).alias("page_id"), F.col("url").alias("next_url"))
    parent = F.concat(F.lit("http://"), F.regexp_replace(U.extract_domain("url"), r"^[^.]+\.", ""))
    return p.join(nxt, "page_id", "left").withColumn("parent_url", parent)


_PAIRS_SQL = """
    WITH pairs AS (
      SELECT a.page_id, a.url, b.url AS next_url,
             'http://' || regexp_replace({dom}, '^[^.]+\\.', '') AS parent_url
      FROM pages a LEFT JOIN pages b ON b.page_id = a.page_id + 1)
"""


@register(
    "url_same_domain",
    _PAIRS_SQL.format(dom=S.domain("a.url"))
    + f"SELECT page_id, CASE WHEN next_url IS NOT NULL THEN {S.same_domain('url', 'next_url')} END AS same_next, {S.same_domain('url', 'parent_url')} AS same_parent FROM pairs",
)
def url_same_domain(spark, sf):
    d = _neighbour_pairs(spark, sf)
    return d.select(
        "page_id",
        F.when(F.col("next_url").isNotNull(), U.is_same_domain("url", "next_url")).alias("same_next"),
        U.is_same_domain("url", "parent_url").alias("same_parent"),
    )


@register(
    "url_is_subdomain",
    _PAIRS_SQL.format(dom=S.domain("a.url"))
    + f"SELECT page_id, CASE WHEN next_url IS NOT NULL THEN {S.is_subdomain('url', 'next_url')} END AS sub_next, {S.is_subdomain('url', 'parent_url')} AS sub_parent, "
    f"{S.is_subdomain('parent_url', 'url')} AS parent_sub FROM pairs",
)
def url_is_subdomain(spark, sf):
    d = _neighbour_pairs(spark, sf)
    return d.select(
        "page_id",
        F.when(F.col("next_url").isNotNull(), U.is_subdomain("url", "next_url")).alias("sub_next"),
        U.is_subdomain("url", "parent_url").alias("sub_parent"),
        U.is_subdomain("parent_url", "url").alias("parent_sub"),
    )


# ------------------------------------------------------------------ paths


@register(
    "filename_sanitize",
    f"SELECT uid, {S.sanitize('url')} AS name120, {S.sanitize('url', 40)} AS name40 FROM url_variants",
    ("url_variants",),
)
def filename_sanitize(spark, sf):
    v = X.url_variants(spark, sf)
    return v.select("uid", P.sanitize_filename("url").alias("name120"), P.sanitize_filename("url", 40).alias("name40"))


@register("output_path", f"SELECT uid, {S.output_path('out', 'url')} AS path FROM url_variants", ("url_variants",))
def output_path(spark, sf):
    return X.url_variants(spark, sf).select("uid", P.build_output_path("out", F.col("url")).alias("path"))


@register(
    "document_path",
    "SELECT uid, " + S.document_path("out", "url") + " AS path, "
    + S.document_path("out", "long_url") + " AS long_path FROM (SELECT uid, url, url || '/' || repeat(left(md5(url), 8), 16) AS long_url FROM url_variants) t",
    ("url_variants",),
)
def document_path(spark, sf):
    v = X.url_variants(spark, sf)
    long_url = F.concat(F.col("url"), F.lit("/"), F.repeat(F.substring(F.md5("url"), 1, 8), 16))
    return v.select(
        "uid",
        P.document_path("out", F.col("url")).alias("path"),
        P.document_path("out", long_url).alias("long_path"),
    )


@register("content_hash", "SELECT doc_id, md5(text) AS md5, sha1(text) AS sha1, sha256(text) AS sha256 FROM documents")
def content_hash(spark, sf):
    d = documents(spark, sf)
    return d.select(
        "doc_id",
        U.content_hash("text", "md5").alias("md5"),
        U.content_hash("text", "sha1").alias("sha1"),
        U.content_hash("text", "sha256").alias("sha256"),
    )


@register("url_hash", "SELECT page_id, md5(url) AS url_md5, sha1(url) AS url_sha1, sha256(url) AS url_sha256 FROM pages")
def url_hash(spark, sf):
    p = pages(spark, sf)
    return p.select(
        "page_id",
        U.url_hash("url", "md5").alias("url_md5"),
        U.url_hash("url", "sha1").alias("url_sha1"),
        U.url_hash("url", "sha256").alias("url_sha256"),
    )


@register(
    "size_label",
    f"SELECT page_id, {S.size_label('length(html)')} AS html_size, "
    f"{S.size_label('CAST(length(html) AS BIGINT) * length(html) * length(html)')} AS cubed_size FROM pages",
)
def size_label(spark, sf):
    p = pages(spark, sf)
    n = F.length("html").cast("bigint")
    return p.select("page_id", P.format_bytes(n).alias("html_size"), P.format_bytes(n * n * n).alias("cubed_size"))


# ------------------------------------------------------------ settings merge

_DEFAULTS = [("format", "markdown"), ("threads", "20")]


def merge_entries(*entry_arrays):
    """Merge ``array<struct<key,value>>`` dictionaries, later wins, first-
    seen key order kept, empty ones skipped; returns the merged entry array."""
    allv = F.concat(*[F.coalesce(e, F.array().cast("array<struct<key:string,value:string>>")) for e in entry_arrays])
    keys = F.array_distinct(F.transform(allv, lambda e: e["key"]))
    return F.transform(
        keys,
        lambda k: F.struct(k.alias("key"), F.element_at(F.filter(allv, lambda e: e["key"] == k), -1)["value"].alias("value")),
    )


@register(
    "settings_merge",
    """
    WITH d AS (
      SELECT page_id,
        [{'key': 'format', 'value': 'markdown'}, {'key': 'threads', 'value': '20'}]
        || list_transform(list_filter(string_split(CASE WHEN strpos(split_part(url, '#', 1), '?') > 0
                 THEN substr(split_part(url, '#', 1), strpos(split_part(url, '#', 1), '?') + 1) ELSE '' END, '&'),
               lambda p: strpos(p, '=') > 0),
             lambda p: {'key': split_part(p, '=', 1), 'value': substr(p, strpos(p, '=') + 1)})
        || CASE WHEN regexp_extract(html, '<html lang="([^"]*)"', 1) = '' THEN []
                ELSE [{'key': 'lang', 'value': regexp_extract(html, '<html lang="([^"]*)"', 1)},
                      {'key': 'format', 'value': 'html'}] END AS entries
      FROM pages),
    m AS (
      SELECT page_id, list_transform(list_filter(list_transform(entries, lambda e: e.key), lambda k, i: list_position(list_transform(entries, lambda e: e.key), k) = i),
             lambda k: {'key': k, 'value': list_filter(entries, lambda e: e.key = k)[-1].value}) AS merged
      FROM d)
    SELECT page_id, CAST(generate_subscripts(merged, 1) - 1 AS INTEGER) AS pos,
           unnest(merged).key AS key, unnest(merged).value AS value FROM m
    """,
)
def settings_merge(spark, sf):
    p = pages(spark, sf)
    defaults = F.array(*[F.struct(F.lit(k).alias("key"), F.lit(v).alias("value")) for k, v in _DEFAULTS])
    u = F.substring_index(F.col("url"), "#", 1)
    query = F.when(F.instr(u, "?") > 0, u.substr(F.instr(u, "?") + 1, F.lit(1 << 30))).otherwise(F.lit(""))
    params = F.transform(
        F.filter(F.split(query, "&"), lambda s: F.instr(s, "=") > 0),
        lambda s: F.struct(F.substring_index(s, "=", 1).alias("key"), s.substr(F.instr(s, "=") + 1, F.lit(1 << 30)).alias("value")),
    )
    lang = F.regexp_extract(F.col("html"), r'<html lang="([^"]*)"', 1)
    page = F.when(lang == "", F.array().cast("array<struct<key:string,value:string>>")).otherwise(
        F.array(F.struct(F.lit("lang").alias("key"), lang.alias("value")), F.struct(F.lit("format").alias("key"), F.lit("html").alias("value")))
    )
    merged = merge_entries(defaults, params, page)
    return p.select("page_id", F.posexplode(merged).alias("pos", "e")).select("page_id", "pos", "e.key", "e.value")


# ------------------------------------------------------------- transcripts

def _vid_sql(x: str) -> str:
    return f"nullif(regexp_extract({x}, {S.q(VIDEO_ID_PATTERN)}, 1), '')"


def _clean_sql(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '\\[\\d+:\\d+:\\d+\\]', '', 'g'), '<\\w+>', '', 'g')"


@register("video_id", "SELECT conv_id, url, " + _vid_sql("url") + " AS video_id FROM derived_videos", ("derived_videos",))
def video_id(spark, sf):
    return X.derived_videos(spark, sf).select("conv_id", "url", T.video_id("url").alias("video_id"))


@register(
    "transcript_clean",
    f"SELECT video_id, seq, lang, {_clean_sql('text')} AS text FROM derived_captions",
    ("derived_captions",),
)
def transcript_clean(spark, sf):
    c = X.derived_captions(spark, sf)
    return c.select("video_id", "seq", "lang", T.clean_transcript("text").alias("text"))


def transcripts(spark, sf):
    """K-S4 + F11: auto-generated English snippets joined by newlines in
    sequence order, one row per video (a video's transcript is one document)."""
    c = X.derived_captions(spark, sf).where((F.col("lang") == "en") & F.col("is_generated"))
    return c.groupBy("video_id").agg(F.expr("listagg(text, '\\n') WITHIN GROUP (ORDER BY seq)").alias("transcript"))


_TRANSCRIPTS_SQL = """transcripts AS (
      SELECT video_id, string_agg(text, chr(10) ORDER BY seq) AS transcript
      FROM derived_captions WHERE lang = 'en' AND is_generated GROUP BY video_id)"""


@register("transcript_text", f"WITH {_TRANSCRIPTS_SQL} SELECT video_id, transcript FROM transcripts", ("derived_captions",))
def transcript_text(spark, sf):
    return transcripts(spark, sf)


def transcript_documents(spark, sf):
    """One markdown document per video URL with a transcript, stored
    under the canonical watch URL; URLs are canonicalised (P1) first."""
    v = X.derived_videos(spark, sf).select("conv_id", U.normalize_url("url").alias("url"))
    v = v.withColumn("video_id", T.video_id("url")).where(F.col("video_id").isNotNull())
    t = transcripts(spark, sf).select("video_id", T.clean_transcript("transcript").alias("text")).where(F.col("text") != "")
    j = v.join(t, "video_id")
    md = T.transcript_markdown(F.col("video_id"), F.col("url"), F.col("text"))
    return j.select("conv_id", T.canonical_video_url(F.col("video_id")).alias("url"), md.alias("markdown"))


@register(
    "transcript_markdown",
    f"""WITH {_TRANSCRIPTS_SQL},
    v AS (SELECT conv_id, {S.normalize_url('url')} AS url FROM derived_videos),
    v2 AS (SELECT conv_id, url, {_vid_sql('url')} AS video_id FROM v),
    t AS (SELECT video_id, {_clean_sql('transcript')} AS text FROM transcripts)
    SELECT conv_id, 'https://www.youtube.com/watch?v=' || v2.video_id AS url,
           '# YouTube Transcript: ' || v2.video_id || chr(10) || chr(10) || '**URL:** ' || v2.url || chr(10) || chr(10) || t.text AS markdown,
           CAST(length('# YouTube Transcript: ' || v2.video_id || chr(10) || chr(10) || '**URL:** ' || v2.url || chr(10) || chr(10) || t.text) AS BIGINT) AS size
    FROM v2 JOIN t ON t.video_id = v2.video_id WHERE v2.video_id IS NOT NULL AND t.text <> ''""",
    ("derived_videos", "derived_captions"),
)
def transcript_markdown(spark, sf):
    d = transcript_documents(spark, sf)
    return d.withColumn("size", F.length("markdown").cast("bigint"))


# ----------------------------------------------------------------- content


@register("page_markdown", f"SELECT page_id, url, {S.html_to_markdown('html')} AS markdown FROM pages")
def page_markdown(spark, sf):
    return pages(spark, sf).select("page_id", "url", C.html_to_markdown(F.col("html")).alias("markdown"))


@register(
    "page_markdown_article",
    f"SELECT page_id, url, {S.html_to_markdown('html', 'article')} AS markdown FROM pages",
)
def page_markdown_article(spark, sf):
    """H1 + H3: markdown of the selected ``article`` element only."""
    return pages(spark, sf).select("page_id", "url", C.html_to_markdown(F.col("html"), "article").alias("markdown"))


@register("html_select_article", f"SELECT page_id, {S.select_tag(S.strip_noise('html'), 'article')} AS article FROM pages")
def html_select_article(spark, sf):
    return pages(spark, sf).select("page_id", C.select_tag(C.strip_noise(F.col("html")), "article").alias("article"))


@register("filter_nonblank", "SELECT page_id, " + S.nonblank("html") + " AS nonblank FROM derived_fetch", ("derived_fetch",))
def filter_nonblank(spark, sf):
    return X.derived_fetch(spark, sf).select("page_id", C.is_nonblank("html").alias("nonblank"))


_H1_RE = r"(?is)<h1(?:\s[^>]*)?>.*?</h1\s*>"
_AD_RE = r'(?is)<div\s[^>]*class="ad"[^>]*>.*?</div\s*>'


@register(
    "html_select",
    f"""SELECT page_id, array_to_string(list_concat(regexp_extract_all(c, {S.q(_H1_RE)}, 0), regexp_extract_all(c, {S.q(_AD_RE)}, 0)), chr(10)) AS selected
    FROM (SELECT page_id, {S.strip_noise('html')} AS c FROM pages) t""",
)
def html_select(spark, sf):
    """H1 general path: selectors ``h1`` then ``div.ad`` through the parser
    UDF (noise blocks removed JVM-side first)."""
    from docweave.functions.select import select_elements

    p = pages(spark, sf).select("page_id", C.strip_noise(F.col("html")).alias("c"))
    return p.select("page_id", select_elements(F.col("c"), ["h1", "div.ad"]).alias("selected"))


_NAV_RE = r"(?is)<nav(?:\s[^>]*)?>.*?</nav\s*>"
_A_RE = r"(?is)<a\s[^>]*href=[^>]*>.*?</a\s*>"
_ARTICLE_H1_RE = r"(?is)<article(?:\s[^>]*)?>\s*(<h1(?:\s[^>]*)?>.*?</h1\s*>)"


@register(
    "html_select_path",
    f"""SELECT page_id, array_to_string(list_concat(
        regexp_extract_all(array_to_string(regexp_extract_all(c, {S.q(_NAV_RE)}, 0), ''), {S.q(_A_RE)}, 0),
        regexp_extract_all(c, {S.q(_ARTICLE_H1_RE)}, 1)), chr(10)) AS selected
    FROM (SELECT page_id, {S.strip_noise('html')} AS c FROM pages) t""",
)
def html_select_path(spark, sf):
    """H1 with paths: links in the navigation, then headings directly in an article."""
    from docweave.functions.select import select_elements

    p = pages(spark, sf).select("page_id", C.strip_noise(F.col("html")).alias("c"))
    return p.select("page_id", select_elements(F.col("c"), ["nav li a[href], nav > a[href]", "article > h1"]).alias("selected"))
