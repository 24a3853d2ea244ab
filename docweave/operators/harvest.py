"""One run from spec items to sink rows.

Expanded and de-duplicated items (``sources.spec``) are split into flat and
deep ones; flat items are looked up in the captured pages, deep items are
crawled over a link graph, videos are joined to their transcripts.  The three
phases form one ordered table of saves, which the sinks of
``operators.assemble`` write.  Many specs run at once, ``spec_id`` in every key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.functions import content as C
from docweave.functions import transcripts as T
from docweave.functions.select import select_elements
from docweave.functions.urls import normalize_url
from docweave.operators import crawl as G
from docweave.operators.filters import split_flat_deep, with_item_checks
from docweave.session import ensure_checkpoint_dir

#: Order of the saves of a spec: videos, flat items, deep items; then place in
#: the spec, place in the sitemap, crawl depth and URL.
ORDER = ["phase", "pos", "sub", "depth", "url"]
VIDEO, FLAT, DEEP = 0, 1, 2

_REF = ["spec_id", "persistence", *ORDER]


def selected_markdown(pages: DataFrame) -> DataFrame:
    """H1 + H3: ``(page_id, selectors, content)`` of ``(page_id, selectors, html)``.
    Pages whose item has selectors go through the selector function, the others
    are narrowed to the body by built-in functions alone."""
    chosen = F.coalesce(F.size("selectors") > 0, F.lit(False))
    cleaned = C.strip_noise(F.col("html"))
    named = pages.where(chosen).select("page_id", "selectors", C.once(C.to_markdown(select_elements(cleaned, F.col("selectors")))).alias("content"))
    whole = pages.where(~chosen).select("page_id", "selectors", C.once(C.to_markdown(C.body_of(cleaned))).alias("content"))
    return named.unionByName(whole)


def page_references(items: DataFrame, fetch: DataFrame, edges: DataFrame) -> DataFrame:
    """Pages a run saves, without their text: :data:`ORDER` columns,
    ``page_id`` of the capture and ``selectors`` of the item."""
    flat, deep = split_flat_deep(items)
    flat = flat.select(
        "spec_id", "persistence", F.lit(FLAT).alias("phase"), "pos", "sub", F.lit(0).alias("depth"), "url",
        normalize_url(F.col("url")).alias("key"), "selectors",
    )
    deep = with_item_checks(deep.withColumn("item_id", F.concat_ws(":", "spec_id", "pos", "sub")))
    reported = G.deep_crawl(deep.drop("url"), edges, G.canonical_fetch(fetch)).where("success")
    own = deep.select("item_id", "spec_id", "persistence", "pos", "sub", "selectors")
    deep = reported.join(own, "item_id").select(
        "spec_id", "persistence", F.lit(DEEP).alias("phase"), "pos", "sub", "depth", "url", F.col("url").alias("key"), "selectors"
    )
    captures = G.first_capture(fetch, nonblank=False)
    found = flat.unionByName(deep).join(captures, "key").where((F.col("phase") == DEEP) | F.col("fetched"))
    return found.select(*_REF, "page_id", "selectors")


def video_references(videos: DataFrame) -> DataFrame:
    """Videos with a valid id, at the canonical watch URL; ``source`` is the URL of the spec."""
    v = videos.withColumn("video_id", T.video_id("url")).where(F.col("video_id").isNotNull())
    return v.select(
        "spec_id", "persistence", F.lit(VIDEO).alias("phase"), "pos", F.lit(0).cast("bigint").alias("sub"), F.lit(0).alias("depth"),
        T.canonical_video_url(F.col("video_id")).alias("url"), "video_id", F.col("url").alias("source"),
    )


def harvest(items: DataFrame, videos: DataFrame, fetch: DataFrame, edges: DataFrame, transcripts: DataFrame,
            measure: Callable[[Column], Column] | None = None) -> DataFrame:
    """``(spec_id, persistence, *ORDER, ord, url, content)``: all saves of the
    specs.  ``ord`` is unique and follows (spec_id, :data:`ORDER`).

    ``items`` are expanded and de-duplicated; ``fetch(page_id, url, success,
    html)`` are captured pages, ``edges(src, dst)`` canonical links and
    ``transcripts(video_id, transcript)`` joined captions.  References are
    sorted and numbered without any text and written to the checkpoint folder,
    so the numbers hold when a task runs again; every (page, selectors) pair
    is converted once.  With ``measure``, such as a length, ``content`` is what
    that makes of the text, worked out once a pair, and no text goes to the saves.
    """

    def kept(texts: DataFrame) -> DataFrame:
        texts = texts.where(C.is_nonblank(F.col("content")))
        return texts.withColumn("content", measure(F.col("content"))) if measure else texts

    ensure_checkpoint_dir(items.sparkSession)
    # read by every phase and crawl level: the specs are parsed and expanded once
    items = items.checkpoint(eager=True)
    refs = page_references(items, fetch, edges).unionByName(video_references(videos), allowMissingColumns=True)
    refs = refs.orderBy("spec_id", *ORDER).withColumn("ord", F.monotonically_increasing_id()).checkpoint(eager=True)
    wanted = refs.where(F.col("phase") != VIDEO).select("page_id", "selectors").distinct()
    # conversion costs far more than the bytes tell, so the partitions are not merged by size
    parts = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pages = fetch.select("page_id", "html").repartition(parts, "page_id")
    texts = kept(selected_markdown(wanted.join(pages, "page_id")))
    page_saves = refs.join(texts, ["page_id", "selectors"]).select(*_REF, "ord", "content")
    spoken = transcripts.select("video_id", T.clean_transcript("transcript").alias("text")).where(F.col("text") != "")
    video_saves = refs.where(F.col("phase") == VIDEO).join(spoken, "video_id").select(
        *_REF, "ord", T.transcript_markdown(F.col("video_id"), F.col("source"), F.col("text")).alias("content"))
    return page_saves.unionByName(kept(video_saves))
