"""Registered queries: dedup (W1, W2), sinks and manifests (K1-K4, W3, W6,
W7, A5, A6, A9) and the union of all documents (U2)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from docweave.constants import VIDEO_ID_PATTERN
from docweave.functions import content as C
from docweave.functions import urls as U
from docweave.operators import assemble as A
from docweave.operators import sinks as K
from docweave.operators.windows import first_by_order
from docweave.plans import sqlfrag as S
from docweave.operators.crawl import first_capture
from docweave.plans.q_crawl import _CRAWL_FIX, _CRAWL_SQL, crawl_results
from docweave.plans.q_functions import transcript_documents
from docweave.plans.registry import register
from docweave.session import ensure_checkpoint_dir
from docweave.sources import fixtures as X

# ------------------------------------------------------------------- dedup


@register(
    "dedup_items",
    f"""WITH k AS (SELECT uid, url, {S.normalize_url('url')} AS key FROM url_variants)
    SELECT uid, url FROM k WHERE uid IN (SELECT min(uid) FROM k GROUP BY key)""",
    ("url_variants",),
)
def dedup_items(spark, sf):
    """First item (by ordinal) per canonical URL; the original spelling
    is kept."""
    v = X.url_variants(spark, sf).withColumn("key", U.normalize_url("url"))
    return first_by_order(v, "key", "uid").select("uid", "url")


@register(
    "dedup_urls",
    f"""WITH k AS (SELECT uid, url, {S.cleanup_url('url')} AS key FROM url_variants)
    SELECT uid, url FROM k WHERE uid IN (SELECT min(uid) FROM k GROUP BY key)""",
    ("url_variants",),
)
def dedup_urls(spark, sf):
    """Order-preserving URL dedup on the loose-cleaner key."""
    v = X.url_variants(spark, sf).withColumn("key", U.cleanup_url("url"))
    return first_by_order(v, "key", "uid").select("uid", "url")


# ------------------------------------------------------------------ saves

def flat_saves(spark, sf):
    """Pages handed to the sink by a flat batch: successful captures with
    their markdown, in page order."""
    f = X.derived_fetch(spark, sf).where("success")
    docs = f.select("url", C.once(C.html_to_markdown(F.col("html"))).alias("content"), F.col("page_id").alias("ord"))
    return A.saves(docs)


def variant_saves(spark, sf):
    """Every URL variant saved with its page's markdown (exercises path
    collisions: variants of one page share a file path)."""
    v = X.url_variants(spark, sf).withColumn("page_id", F.floor(F.col("uid") / 8).cast("bigint"))
    md = X.derived_fetch(spark, sf).where("success").select("page_id", C.once(C.html_to_markdown(F.col("html"))).alias("content"))
    return A.saves(v.join(md, "page_id").select("url", "content", F.col("uid").alias("ord")))


_MD = S.html_to_markdown("html")
_DOMAIN_OF = "CASE WHEN {d} = '' THEN 'unknown' ELSE {d} END"

_SAVES_SQL = f"""saves AS (
    SELECT url, content, ord, {_DOMAIN_OF.format(d=S.domain('url'))} AS domain, CAST(length(content) AS BIGINT) AS size
    FROM (SELECT url, {_MD} AS content, page_id AS ord FROM derived_fetch WHERE success) t
    WHERE {S.nonblank('content')})"""

_VSAVES_SQL = f"""md AS (SELECT page_id, {_MD} AS content FROM derived_fetch WHERE success),
  vsaves AS (
    SELECT url, content, ord, {_DOMAIN_OF.format(d=S.domain('url'))} AS domain, CAST(length(content) AS BIGINT) AS size
    FROM (SELECT v.url, md.content, v.uid AS ord FROM url_variants v JOIN md ON md.page_id = v.uid // 8) t
    WHERE {S.nonblank('content')})"""


@register(
    "page_manifest",
    f"WITH {_SAVES_SQL} SELECT url, {S.document_path('out', 'url')} AS path, size, ord FROM saves",
    ("derived_fetch",),
)
def page_manifest(spark, sf):
    return A.page_manifest(flat_saves(spark, sf))


@register(
    "folder_documents",
    f"""WITH {_VSAVES_SQL},
    m AS (SELECT url, {S.document_path('out', 'url')} AS path, size, ord, content FROM vsaves)
    SELECT path, arg_max(url, ord) AS url, arg_max(content, ord) AS content, arg_max(size, ord) AS size, max(ord) AS ord
    FROM m GROUP BY path""",
    ("url_variants", "derived_fetch"),
)
def folder_documents(spark, sf):
    return A.folder_documents(variant_saves(spark, sf)).drop("rel")


@register(
    "path_collisions",
    f"""WITH {_VSAVES_SQL},
    m AS (SELECT url, {S.document_path('out', 'url')} AS path, ord FROM vsaves)
    SELECT path, count(*) AS saves, count(DISTINCT url) AS urls, arg_min(url, ord) AS first_url, arg_max(url, ord) AS last_url
    FROM m GROUP BY path HAVING count(*) > 1""",
    ("url_variants", "derived_fetch"),
)
def path_collisions(spark, sf):
    return A.path_collisions(variant_saves(spark, sf))


_ORDER_SQL = f"""{_SAVES_SQL},
  ordered AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY ord) AS page_no FROM saves)"""


@register(
    "domain_page_order",
    f"WITH {_ORDER_SQL} SELECT domain, url, ord, page_no FROM ordered",
    ("derived_fetch",),
)
def domain_page_order(spark, sf):
    return A.domain_page_order(flat_saves(spark, sf).drop("content")).select("domain", "url", "ord", "page_no")


FLUSH_BUFFER = 3


@register(
    "flush_batches",
    f"WITH {_ORDER_SQL} SELECT domain, url, ord, page_no, CAST((page_no - 1) // {FLUSH_BUFFER} AS BIGINT) AS flush_id FROM ordered",
    ("derived_fetch",),
)
def flush_batches(spark, sf):
    b = A.flush_batches(flat_saves(spark, sf).drop("content"), buffer_size=FLUSH_BUFFER)
    return b.select("domain", "url", "ord", "page_no", "flush_id")


@register(
    "flush_manifest",
    f"""WITH {_ORDER_SQL}
    SELECT domain, CAST((page_no - 1) // {FLUSH_BUFFER} AS BIGINT) AS flush_id, count(*) AS pages, CAST(sum(size) AS BIGINT) AS size,
           string_agg(url, chr(10) ORDER BY ord) AS urls, 'out/' || domain || '.md' AS path
    FROM ordered GROUP BY 1, 2""",
    ("derived_fetch",),
)
def flush_manifest(spark, sf):
    return A.flush_manifest(A.flush_batches(flat_saves(spark, sf).drop("content"), buffer_size=FLUSH_BUFFER))


SIZED_FLUSH_MB = 0.005


@register(
    "flush_manifest_sized",
    f"""WITH RECURSIVE {_ORDER_SQL},
    walk AS (
      SELECT domain, url, ord, page_no, size, 1 AS n, size AS total, CAST(0 AS BIGINT) AS flush_id FROM ordered WHERE page_no = 1
      UNION ALL
      SELECT o.domain, o.url, o.ord, o.page_no, o.size,
             CASE WHEN w.n >= {FLUSH_BUFFER} OR w.total >= {int(SIZED_FLUSH_MB * 1024 * 1024)} THEN 1 ELSE w.n + 1 END,
             CASE WHEN w.n >= {FLUSH_BUFFER} OR w.total >= {int(SIZED_FLUSH_MB * 1024 * 1024)} THEN o.size ELSE w.total + o.size END,
             CASE WHEN w.n >= {FLUSH_BUFFER} OR w.total >= {int(SIZED_FLUSH_MB * 1024 * 1024)} THEN w.flush_id + 1 ELSE w.flush_id END
      FROM walk w JOIN ordered o ON o.domain = w.domain AND o.page_no = w.page_no + 1)
    SELECT domain, flush_id, count(*) AS pages, CAST(sum(size) AS BIGINT) AS size,
           string_agg(url, chr(10) ORDER BY ord) AS urls, 'out/' || domain || '.md' AS path
    FROM walk GROUP BY domain, flush_id""",
    ("derived_fetch",),
)
def flush_manifest_sized(spark, sf):
    """A5 with the size limit as well: 3 pages or 0.005 MB (5,242 characters),
    whichever comes first."""
    b = A.flush_batches(flat_saves(spark, sf).drop("content"), buffer_size=FLUSH_BUFFER, flush_size_mb=SIZED_FLUSH_MB)
    return A.flush_manifest(b)


_BLOCK_SQL = """CASE WHEN page_no > 1 THEN chr(10) || chr(10) || '---' || chr(10) || chr(10) ELSE '' END
                || '# ' || url || chr(10) || chr(10) || content"""


@register(
    "domain_documents",
    f"WITH {_ORDER_SQL} SELECT domain, page_no, url, {_BLOCK_SQL} AS block FROM ordered",
    ("derived_fetch",),
)
def domain_documents(spark, sf):
    return A.domain_blocks(flat_saves(spark, sf)).select("domain", "page_no", "url", "block")


@register(
    "domain_manifest",
    f"""WITH {_ORDER_SQL}
    SELECT domain, count(*) AS pages, CAST(sum(size) AS BIGINT) AS size, CAST(sum(length({_BLOCK_SQL})) AS BIGINT) AS doc_chars,
           arg_min(url, ord) AS first_url, arg_max(url, ord) AS last_url, 'out/' || domain || '.md' AS path
    FROM ordered GROUP BY domain""",
    ("derived_fetch",),
)
def domain_manifest(spark, sf):
    return A.domain_manifest(flat_saves(spark, sf))


# ------------------------------------------------------------------- sinks


def _written(spark, saved, name, strategy):
    out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    A.write_documents(saved, out, strategy)
    return K.written(spark, out)


@register(
    "folder_files",
    f"""WITH {_VSAVES_SQL},
    m AS (SELECT {S.document_path('out', 'url')} AS path, ord, content FROM vsaves)
    SELECT substr(path, 5) AS rel, arg_max(content, ord) AS content FROM m GROUP BY path""",
    ("url_variants", "derived_fetch"),
)
def folder_files(spark, sf):
    """K1 + K5: the files of the folder-per-domain sink, written and read back."""
    return _written(spark, variant_saves(spark, sf), "folder-files", "folder_per_domain")


@register(
    "domain_files",
    f"""WITH {_ORDER_SQL}
    SELECT domain || '.md' AS rel, string_agg({_BLOCK_SQL}, '' ORDER BY page_no) AS content FROM ordered GROUP BY domain""",
    ("derived_fetch",),
)
def domain_files(spark, sf):
    """K2 + K5: the documents of the file-per-domain sink, written and read back."""
    return _written(spark, flat_saves(spark, sf), "domain-files", "file_per_domain")


# ------------------------------------------------------------------- union


def all_documents_df(spark, sf):
    """Transcripts, then flat pages, then deep-crawl pages, one sink
    input; ``ord`` encodes (phase, position) so the phases stay in order."""
    tr = transcript_documents(spark, sf).select(
        F.lit("youtube").alias("phase"), "url", F.col("markdown").alias("content"), F.col("conv_id").alias("pos")
    )
    flat = X.derived_fetch(spark, sf).select(
        F.lit("flat").alias("phase"), "url", C.html_to_markdown(F.col("html")).alias("content"), F.col("page_id").alias("pos"),
        "success",
    ).where("success").drop("success")
    deep = crawl_results(spark, sf).where(F.col("status") == "success")
    cap = first_capture(X.derived_fetch(spark, sf), nonblank=False).select(F.col("key").alias("url"), "page_id")
    html = X.derived_fetch(spark, sf).select("page_id", "html")
    deep = deep.join(cap, "url").join(html, "page_id").select(
        F.lit("deep").alias("phase"), "url", C.html_to_markdown(F.col("html")).alias("content"), F.col("page_id").alias("pos")
    )
    return tr.unionByName(flat).unionByName(deep)


@register(
    "all_documents",
    f"""WITH RECURSIVE {_CRAWL_SQL},
    vids AS (SELECT conv_id, {S.normalize_url('url')} AS url FROM derived_videos),
    tx AS (SELECT video_id, string_agg(text, chr(10) ORDER BY seq) AS transcript
           FROM derived_captions WHERE lang = 'en' AND is_generated GROUP BY video_id),
    tv AS (SELECT conv_id, url, nullif(regexp_extract(url, {S.q(VIDEO_ID_PATTERN)}, 1), '') AS video_id FROM vids),
    tt AS (SELECT video_id, regexp_replace(regexp_replace(transcript, '\\[\\d+:\\d+:\\d+\\]', '', 'g'), '<\\w+>', '', 'g') AS text FROM tx),
    docs AS (
      SELECT 'youtube' AS phase, 'https://www.youtube.com/watch?v=' || tv.video_id AS url,
             '# YouTube Transcript: ' || tv.video_id || chr(10) || chr(10) || '**URL:** ' || tv.url || chr(10) || chr(10) || tt.text AS content
      FROM tv JOIN tt ON tt.video_id = tv.video_id WHERE tv.video_id IS NOT NULL AND tt.text <> ''
      UNION ALL
      SELECT 'flat', url, {_MD} FROM derived_fetch WHERE success
      UNION ALL
      SELECT 'deep', r.url, {S.html_to_markdown('cap.html')} FROM results r JOIN cap ON cap.key = r.url WHERE r.status = 'success')
    SELECT phase, count(*) AS documents, CAST(sum(length(content)) AS BIGINT) AS chars,
           count(*) FILTER (WHERE {S.nonblank('content')}) AS saved
    FROM docs GROUP BY phase""",
    _CRAWL_FIX + ("derived_videos", "derived_captions"),
)
def all_documents(spark, sf):
    d = all_documents_df(spark, sf)
    return d.groupBy("phase").agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum(F.length("content")).cast("bigint").alias("chars"),
        F.count(F.when(C.is_nonblank(F.col("content")), 1)).alias("saved"),
    )
