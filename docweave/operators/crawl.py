"""Deep crawl over a captured link graph (operators G1-G3, J3, J4, W4, W5).

Semantics (fixed here because the original delegates them): the seed is
never filtered and sits at depth 0; a link is followed from a successfully
fetched page only; a URL is visited once per item, at its smallest depth;
pages are ranked per item by ``(depth, url)``; ``max_depth`` is inclusive and
``max_pages`` counts successful pages.  A page past the budget is neither
emitted nor expanded; a failed page is reported if fewer than ``max_pages``
successes precede it.

All items traverse together (``item_id`` is part of every key), one join
round per depth level (or per batch of a scored crawl).  Each level is written
to the shared checkpoint folder so lineage stays short and a lost executor
recomputes one level only.  The link table is dealt by source once; no level
moves it again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweave.functions.content import html_to_markdown, is_nonblank
from docweave.functions.urls import normalize_url
from docweave.operators.filters import filter_chain
from docweave.session import ensure_checkpoint_dir

SALT_BUCKETS = 64
#: Most items whose settings (a few hundred bytes each) are broadcast.
BROADCAST_ITEMS = 50_000
#: URLs an item visits in one round of a scored crawl.
BATCH_PAGES = 10
ORDERS = ("best_first", "bfs")

SETTINGS_COLS = [
    "item_id", "seed_url", "domain", "regex_valid", "paths_to_skip_regex",
    "include_subdomains", "include_external", "max_depth", "max_pages",
]


def _persist_level(df: DataFrame, checkpoint: bool) -> DataFrame:
    return df.checkpoint(eager=True) if checkpoint else df


def _persist_in_place(df: DataFrame, checkpoint: bool) -> DataFrame:
    """Checkpoint that keeps partitioning and order for later joins.  Only a plan
    that isn't adaptive tells them, so ``df`` must not need skewed keys split."""
    adaptive, conf = "spark.sql.adaptive.enabled", df.sparkSession.conf
    before = conf.get(adaptive)
    conf.set(adaptive, "false")
    try:
        return _persist_level(df, checkpoint)
    finally:
        conf.set(adaptive, before)


class _Items:
    """Tables with a row an item, joined to rows of which one item may hold a
    third: broadcast up to a counted number of items, beyond that by an adaptive
    join, which splits the hot one, written before the plan goes on."""

    def __init__(self, settings: DataFrame, checkpoint: bool):
        self.settings, self.checkpoint = settings, checkpoint
        self.small = settings.count() <= BROADCAST_ITEMS

    def join(self, rows: DataFrame, side: DataFrame, how: str = "inner") -> DataFrame:
        if self.small:
            return rows.join(F.broadcast(side), "item_id", how)
        return _persist_level(rows.join(side, "item_id", how), self.checkpoint)


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def link_graph(edges: DataFrame, fetch: DataFrame, checkpoint: bool = True) -> DataFrame:
    """``(src, dst, dst_ok)`` by source: dealt by ``src`` and sorted once, with the
    fetch status of the target, so that a crawl level joins it without moving
    it and looks nothing else up.  The checkpoint keeps partitioning and order."""
    ok = fetch.where("success").select(F.col("url").alias("dst"), F.lit(True).alias("dst_ok"))
    known = edges.select("src", "dst").join(ok, "dst", "left").select("src", "dst", F.coalesce("dst_ok", F.lit(False)).alias("dst_ok"))
    known = _persist_level(known, checkpoint)  # an adaptive plan: much-linked targets are split
    return _persist_in_place(known.repartition(_partitions(edges), "src").sortWithinPartitions("src"), checkpoint)


def seed_pages(settings: DataFrame, fetch: DataFrame) -> DataFrame:
    """``(item_id, url, success)`` of the seeds of valid items."""
    seeds = settings.where(F.col("domain").isNotNull()).select("item_id", normalize_url(F.col("seed_url")).alias("url")).distinct()
    ok = fetch.where("success").select("url", F.lit(True).alias("ok"))
    return seeds.join(ok, "url", "left").select("item_id", "url", F.coalesce("ok", F.lit(False)).alias("success"))


def followed_links(pages: DataFrame, graph: DataFrame, items: _Items) -> DataFrame:
    """Links of ``pages (item_id, url, depth)`` that pass the filters and the
    depth limit of their item: ``(item_id, url, depth, success)``, repeats
    included.  Only ``pages`` are moved, to the partitions of the graph."""
    at = pages.repartition(_partitions(pages), "url")
    found = at.join(graph, at["url"] == graph["src"]).select(
        "item_id", F.col("dst").alias("url"), (F.col("depth") + 1).alias("depth"), F.col("dst_ok").alias("success"))
    allowed = items.join(found, items.settings).where((F.col("depth") <= F.col("max_depth")) & filter_chain(F.col("url")))
    return allowed.select("item_id", "url", "depth", "success")


def crawl_levels(
    items: DataFrame,
    edges: DataFrame,
    fetch: DataFrame,
    checkpoint: bool = True,
) -> DataFrame:
    """Breadth-first levels: ``(item_id, url, depth, success)`` for every URL
    reachable within ``max_depth`` through successful pages, at its smallest depth.

    ``items`` carries :data:`SETTINGS_COLS`; ``edges(src, dst)`` and
    ``fetch(url, success)`` are keyed by canonical URL.  Items whose budget is
    already full stop expanding (their deeper levels would be cut anyway).
    A level moves its pages to the graph and the links it finds, merged map-side,
    to the pages seen; graph and seen pages stay where they are.  Only the new
    level is written at each depth, with its fetch status, so successes are
    counted per level and never looked up again.
    """
    if checkpoint:
        ensure_checkpoint_dir(items.sparkSession)
    settings = items.select(*SETTINGS_COLS)
    by_item = _Items(settings, checkpoint)
    graph = link_graph(edges, fetch, checkpoint)
    parts = _partitions(items)

    def level_successes(rows: DataFrame) -> DataFrame:
        return rows.where("success").groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))

    seeds = seed_pages(settings, fetch).withColumn("depth", F.lit(0)).select("item_id", "url", "depth", "success")
    frontier = _persist_in_place(seeds.repartition(parts, "item_id", "url"), checkpoint)
    levels = [frontier]
    successes = level_successes(frontier)
    max_depth = settings.agg(F.max("max_depth")).first()[0] or 0
    for depth in range(1, max_depth + 1):
        # items whose successes so far already fill the budget stop here
        spent = successes.groupBy("item_id").agg(F.sum("n").alias("n"))
        full = spent.join(settings.select("item_id", "max_pages"), "item_id").where(F.col("n") >= F.col("max_pages"))
        expand = by_item.join(frontier.where("success"), full.select("item_id"), "left_anti")
        links = followed_links(expand, graph, by_item).groupBy("item_id", "url").agg(F.min("depth").alias("depth"), F.bool_or("success").alias("success"))
        new = links.repartition(parts, "item_id", "url")
        for lvl in levels:  # one anti-join a level, each with a part that stays in place
            new = new.join(lvl.select("item_id", "url"), ["item_id", "url"], "left_anti")
        new = _persist_in_place(new.select("item_id", "url", "depth", "success"), checkpoint)
        if new.isEmpty():
            break
        levels.append(new)
        successes = successes.unionByName(level_successes(new))
        frontier = new
    return _union(levels)


def best_first_crawl(
    items: DataFrame,
    edges: DataFrame,
    fetch: DataFrame,
    score: Callable[[Column], Column],
    batch: int = BATCH_PAGES,
    checkpoint: bool = True,
) -> DataFrame:
    """G1 with link scores: ``(item_id, url, depth, success, score, round)``.

    Every item has a frontier of URLs it knows and has not visited, the seed
    first.  A round visits the ``batch`` best of each frontier in the order
    (score descending, depth, url) and puts the links of the successful ones
    that pass the item's filters into the frontier; a URL found again before
    its visit keeps its smallest depth.  An item ends when ``max_pages``
    successes are visited or its frontier is empty.  ``score`` makes a URL's
    score from its column.

    All items go through a round together.  The best of a frontier are a ranked
    window with a limit, which Spark cuts to ``batch`` rows an item in every
    task before it moves them, so a hot item's frontier is never in one place.
    A round writes the pages it visits and the frontier that is left.
    """
    if checkpoint:
        ensure_checkpoint_dir(items.sparkSession)
    settings = items.select(*SETTINGS_COLS)
    by_item = _Items(settings, checkpoint)
    graph = link_graph(edges, fetch, checkpoint)
    parts = _partitions(items)
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), "depth", "url")
    earlier = best.rowsBetween(Window.unboundedPreceding, -1)
    frontier = seed_pages(settings, fetch).withColumn("depth", F.lit(0)).withColumn("score", score(F.col("url")).cast("double"))
    frontier = frontier.select("item_id", "url", "depth", "success", "score")
    frontier = _persist_in_place(frontier.repartition(parts, "item_id", "url"), checkpoint)
    rounds: list[DataFrame] = []
    while True:
        left = settings.select("item_id", F.col("max_pages").cast("bigint").alias("left"))
        if rounds:
            spent = _union(rounds).where("success").groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
            left = left.join(spent, "item_id", "left").select("item_id", (F.col("left") - F.coalesce("n", F.lit(0))).alias("left"))
        open_ = by_item.join(frontier, left.where("left > 0"))
        top = open_.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= batch)
        before = F.coalesce(F.sum(F.col("success").cast("int")).over(earlier), F.lit(0))
        taken = top.withColumn("before", before).where("before < left")
        taken = taken.select("item_id", "url", "depth", "success", "score", F.lit(len(rounds)).alias("round"))
        taken = _persist_in_place(taken.repartition(parts, "item_id", "url"), checkpoint)
        if taken.isEmpty():
            break
        rounds.append(taken)
        links = followed_links(taken.where("success"), graph, by_item)
        links = links.groupBy("item_id", "url").agg(F.min("depth").alias("depth"), F.bool_or("success").alias("success"))
        links = links.repartition(parts, "item_id", "url").withColumn("score", score(F.col("url")).cast("double"))
        for done in rounds:
            links = links.join(done.select("item_id", "url"), ["item_id", "url"], "left_anti")
        rest = frontier.join(taken.select("item_id", "url"), ["item_id", "url"], "left_anti")
        frontier = rest.unionByName(links).repartition(parts, "item_id", "url").groupBy("item_id", "url").agg(
            F.min("depth").alias("depth"), F.first("success").alias("success"), F.first("score").alias("score"))
        frontier = _persist_in_place(frontier, checkpoint)
    return _union(rounds or [taken])


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def apply_page_budget(visited: DataFrame, settings: DataFrame, salt_buckets: int = SALT_BUCKETS) -> DataFrame:
    """Keep rows with fewer than ``max_pages`` successes before them in
    ``(depth, url)`` order, without sorting any item as a whole.

    Successes are counted per ``(item, depth)`` (hash aggregate) and prefix-
    summed over the few depth levels; only the level where the budget runs
    out needs a URL threshold, found as the k-th smallest successful URL by a
    salted two-phase top-k (each salt keeps its k smallest first).
    """
    s = settings.select("item_id", "max_pages")
    per_level = visited.groupBy("item_id", "depth").agg(F.sum(F.col("success").cast("int")).alias("s"))
    w = Window.partitionBy("item_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    levels = per_level.join(s, "item_id").withColumn("before", F.coalesce(F.sum("s").over(w), F.lit(0)))
    cut = levels.where((F.col("before") < F.col("max_pages")) & (F.col("before") + F.col("s") >= F.col("max_pages"))).select(
        "item_id", F.col("depth").alias("cut_depth"), (F.col("max_pages") - F.col("before")).alias("need")
    )
    at_cut = (
        visited.where("success")
        .withColumnRenamed("depth", "cut_depth")
        .join(cut, ["item_id", "cut_depth"])
        .select("item_id", "url", "need")
    )
    salted = at_cut.withColumn("salt", F.pmod(F.xxhash64("url"), F.lit(salt_buckets)))
    w1 = Window.partitionBy("item_id", "salt").orderBy("url")
    top = salted.withColumn("r1", F.row_number().over(w1)).where(F.col("r1") <= F.col("need"))
    w2 = Window.partitionBy("item_id").orderBy("url")
    threshold = (
        top.withColumn("r2", F.row_number().over(w2)).where(F.col("r2") == F.col("need")).select("item_id", F.col("url").alias("t_url"))
    )
    bounds = cut.join(threshold, "item_id").select("item_id", "cut_depth", "t_url")
    return (
        visited.join(levels.select("item_id", "depth", "before", "max_pages"), ["item_id", "depth"])
        .join(bounds, "item_id", "left")
        .where(
            (F.col("before") < F.col("max_pages"))
            & (F.col("t_url").isNull() | (F.col("depth") != F.col("cut_depth")) | (F.col("url") <= F.col("t_url")))
        )
        .drop("before", "max_pages", "cut_depth", "t_url")
    )


def deep_crawl(
    items: DataFrame,
    edges: DataFrame,
    fetch: DataFrame,
    order: str = "best_first",
    checkpoint: bool = True,
    score: Callable[[Column], Column] | None = None,
    batch: int = BATCH_PAGES,
) -> DataFrame:
    """``(item_id, url, depth, success)`` of the pages a deep crawl of
    each item reports.  Without link scores best-first and breadth-first
    visit the same pages in the same ``(depth, url)`` order; with ``score``
    best-first is :func:`best_first_crawl`, whose columns come along."""
    if order not in ORDERS:
        raise ValueError(f"unknown crawl order {order!r}; use one of {ORDERS}")
    if score is not None:
        if order != "best_first":
            raise ValueError("scores need the best_first order")
        return best_first_crawl(items, edges, fetch, score, batch, checkpoint)
    visited = crawl_levels(items, edges, fetch, checkpoint=checkpoint)
    return apply_page_budget(visited, items.select(*SETTINGS_COLS))


def canonical_edges(links: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Link table keyed by canonical URLs, duplicates removed."""
    return links.select(normalize_url(F.col(src)).alias("src"), normalize_url(F.col(dst)).alias("dst")).distinct()


def first_capture(fetch, nonblank: bool = True):
    """``(key, page_id, fetched, nonblank)``: the capture that counts for a canonical
    URL, whatever its spelling: the successful one of lowest page id, or the
    lowest failed one.  Both flags are decided where the page is scanned and
    ride in the low bits of the id, so bigints are aggregated and no page text
    is moved (ids take 61 bits).  Without ``nonblank`` no page is read or
    converted, and that column is absent."""
    flags = F.when(F.col("success"), 2).otherwise(0)
    if nonblank:
        flags = flags + F.when(is_nonblank(html_to_markdown(F.col("html"))), 1).otherwise(0)
    keyed = fetch.select(normalize_url(F.col("url")).alias("key"), (F.shiftleft(F.col("page_id").cast("bigint"), 2) + flags).alias("c"))
    c = F.col("c")
    good = F.min(F.when(c.bitwiseAND(2) != 0, c))
    first = keyed.groupBy("key").agg(F.coalesce(good, F.min(c)).alias("c")).select(
        "key", F.shiftright(c, 2).alias("page_id"), (c.bitwiseAND(2) != 0).alias("fetched"), (c.bitwiseAND(1) != 0).alias("nonblank")
    )
    return first if nonblank else first.drop("nonblank")


def capture_status(success):
    """F13 over the ``nonblank`` flag of a joined capture."""
    return F.when(~success, "failed").when(F.coalesce("nonblank", F.lit(False)), "success").otherwise("skipped")


def canonical_fetch(fetch: DataFrame, url: str = "url") -> DataFrame:
    """``(url, success)`` by canonical URL; a key fetched successfully under
    any spelling counts as fetched, as in :func:`first_capture`."""
    return fetch.groupBy(normalize_url(F.col(url)).alias("url")).agg(F.bool_or("success").alias("success"))


def unvisited(candidates: DataFrame, visited: DataFrame, key: str = "norm_url") -> DataFrame:
    """Candidates whose canonical key is not in the visited set."""
    return candidates.join(visited.select(key).distinct(), key, "left_anti")


def visited_set(*frames: DataFrame, key: str = "norm_url") -> DataFrame:
    """Distinct canonical URLs marked visited by one or more runs."""
    out = None
    for f in frames:
        part = f.select(key)
        out = part if out is None else out.unionByName(part)
    return out.distinct()


class VisitedStore:
    """The visited set kept between runs as a parquet table of canonical
    URLs (in shared storage): ``mark`` adds keys not yet present (anti-join,
    append), ``get`` reads them, ``clear`` empties the table."""

    SCHEMA = "norm_url string"

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path

    def get(self) -> DataFrame:
        try:
            return self.spark.read.schema(self.SCHEMA).parquet(self.path)
        except AnalysisException as e:  # no table yet
            if "PATH_NOT_FOUND" not in str(e.getCondition()):
                raise
            return self.spark.createDataFrame([], self.SCHEMA)

    def mark(self, urls: DataFrame, col: str = "url") -> int:
        ensure_checkpoint_dir(self.spark)
        new = urls.select(normalize_url(F.col(col)).alias("norm_url")).distinct()
        new = new.join(self.get(), "norm_url", "left_anti").checkpoint(eager=True)
        n = new.count()
        if n:
            new.write.mode("append").parquet(self.path)
        return n

    def clear(self) -> None:
        self.spark.createDataFrame([], self.SCHEMA).write.mode("overwrite").parquet(self.path)
