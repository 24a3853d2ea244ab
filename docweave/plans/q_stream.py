"""Registered streaming queries (S1-S5): each drains the pages folder with an
``availableNow`` trigger and returns the sink's content as a DataFrame."""

from __future__ import annotations

from pyspark.sql import functions as F

from docweave.constants import FLUSH_SIZE_MB
from docweave.functions.content import html_to_markdown, once
from docweave.operators import assemble as A
from docweave.operators import sinks as K
from docweave.plans import sqlfrag as S
from docweave.plans.registry import register
from docweave.sources.fixtures import URL_VARIANT_SUFFIXES
from docweave.streaming import stream as ST

_MD = S.html_to_markdown("html")
_DOCS_SQL = f"""docs AS (
    SELECT page_id, {S.normalize_url('url')} AS url, {S.domain('url')} AS domain,
           CASE WHEN {S.nonblank('md')} THEN 'success' ELSE 'skipped' END AS status, CAST(length(md) AS BIGINT) AS size
    FROM (SELECT *, {_MD} AS md FROM pages) t)"""


@register("stream_documents", f"WITH {_DOCS_SQL} SELECT page_id, url, domain, status, size FROM docs")
def stream_documents(spark, sf):
    """Streaming page intake -> canonical URL, domain, status, size."""
    return ST.run_to_parquet(ST.page_documents(ST.read_pages_stream(spark, sf)), spark, "documents")


@register("stream_dedup", f"SELECT DISTINCT {S.normalize_url('url')} AS key FROM url_variants", ("url_variants",))
def stream_dedup(spark, sf):
    """Every URL variant arrives on the stream; one row per canonical URL
    survives (which duplicate survives depends on arrival, so only keys are
    reported)."""
    gen = F.array(*[F.struct(F.lit(k).alias("variant"), F.lit(s).alias("sfx")) for k, s in URL_VARIANT_SUFFIXES])
    s = ST.read_pages_stream(spark, sf).select("page_id", "url", F.inline(gen))
    s = s.select(F.concat(F.regexp_replace("url", r"[?#].*$", ""), F.col("sfx")).alias("url"))
    d = ST.stream_dedup(s).select("key")
    return ST.run_to_parquet(d, spark, "dedup")


@register("stream_stats", f"WITH {_DOCS_SQL} SELECT domain, status, count(*) AS pages FROM docs GROUP BY 1, 2")
def stream_stats(spark, sf):
    """S3: running statistics in update mode through foreachBatch."""
    return ST.stream_stats(ST.read_pages_stream(spark, sf), spark)


STREAM_BUFFER = 3


@register(
    "stream_flush",
    f"""WITH {_DOCS_SQL},
    o AS (SELECT domain, page_id, size, row_number() OVER (PARTITION BY domain ORDER BY page_id) AS n FROM docs WHERE status = 'success')
    SELECT domain, CAST((n - 1) // {STREAM_BUFFER} AS BIGINT) AS flush_id, count(*) AS pages, CAST(sum(size) AS BIGINT) AS size
    FROM o GROUP BY 1, 2""",
)
def stream_flush(spark, sf):
    """S4 + K6: per-domain buffered flushing with keyed state (3 pages or
    10 MB); the closing partial flush of each domain is included."""
    tagged = ST.stream_flush(ST.read_pages_stream(spark, sf), spark, STREAM_BUFFER, FLUSH_SIZE_MB * 1024 * 1024)
    return tagged.groupBy("domain", "flush_id").agg(F.count(F.lit(1)).alias("pages"), F.sum("size").cast("bigint").alias("size"))




_SAVES_SQL = f"""saves AS (
    SELECT url, md AS content, page_id AS ord, CASE WHEN {S.domain('url')} = '' THEN 'unknown' ELSE {S.domain('url')} END AS domain
    FROM (SELECT *, {_MD} AS md FROM pages) t WHERE {S.nonblank('md')})"""


def _stream_saves(spark, sf):
    s = ST.read_pages_stream(spark, sf)
    return A.saves(s.select("url", once(html_to_markdown(F.col("html"))).alias("content"), F.col("page_id").alias("ord")))


@register(
    "stream_folder_files",
    f"""WITH {_SAVES_SQL}
    SELECT substr(path, 5) AS rel, arg_max(content, ord) AS content
    FROM (SELECT *, {S.document_path('out', 'url')} AS path FROM saves) GROUP BY path""",
)
def stream_folder_files(spark, sf):
    """S5 + K1: a stream written by the folder-per-domain sink, read back."""
    return K.written(spark, ST.run_to_sink(_stream_saves(spark, sf), spark, "folder-sink", "folder_per_domain"))


@register(
    "stream_domain_files",
    f"""WITH {_SAVES_SQL}
    SELECT domain || '.md' AS rel, string_agg('# ' || url || chr(10) || chr(10) || content, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY ord) AS content
    FROM saves GROUP BY domain""",
)
def stream_domain_files(spark, sf):
    """S5 + K2: a stream appended to domain documents in order of arrival, read back."""
    return K.written(spark, ST.run_to_sink(_stream_saves(spark, sf), spark, "domain-sink", "file_per_domain"))
