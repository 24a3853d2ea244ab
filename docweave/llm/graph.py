"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from docweave.llm.common import shared_table


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return row[0], row[1]


def _rewire(pairs: DataFrame) -> DataFrame:
    """Every neighbour ``v`` of ``u`` beside the least of ``u`` and its neighbours."""
    # written first, so that the join sees two plain shuffles and can split a hub
    least = shared_table(pairs.groupBy("u").agg(F.min("v").alias("m")), "cc-least")
    return pairs.join(least, "u").select("u", "v", F.least("u", "m").alias("m"))


def components(links: DataFrame) -> DataFrame:
    """``links (a long, b long)`` -> ``(node long, component long)``.

    ``component`` is the least node that can be reached.  Nodes without a link
    are absent.  Each round is written to the shared folder; the rounds end
    when the edges no longer change, then every edge points at its component.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = shared_table(edges, "cc")
    seen = _signature(edges)
    while seen[0]:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _rewire(both).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
        star = _rewire(down)
        small = star.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            star.select(F.col("u").alias("a"), F.col("m").alias("b")))
        edges = shared_table(small.where("a <> b").distinct(), "cc")
        now = _signature(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots).distinct()
