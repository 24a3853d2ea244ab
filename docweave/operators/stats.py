"""Outcome statistics (operators A1-A4, A7, A8).

All are hash aggregates with Spark's partial (map-side) + final split, so a
hot item or domain costs one partial row per map task, never a whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweave.operators.windows import ordinal_by_range


def _count_if(cond) -> F.Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")


def batch_stats(results: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """A1: total / success / failed / skipped counts from a ``status`` column."""
    aggs = [
        F.count(F.lit(1)).alias("total"),
        _count_if(F.col("status") == "success").alias("success"),
        _count_if(F.col("status") == "failed").alias("failed"),
        _count_if(F.col("status") == "skipped").alias("skipped"),
    ]
    return results.groupBy(*(keys or [])).agg(*aggs)


def deep_crawl_stats(results: DataFrame) -> DataFrame:
    """A2: per item counts over all reported pages; deepest depth and mean
    score over saved (``success``) pages only, 0 when none."""
    saved = F.col("status") == "success"
    score = F.col("score") if "score" in results.columns else F.lit(0.0)
    return results.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("total_pages"),
        _count_if(saved).alias("success"),
        _count_if(F.col("status") == "failed").alias("failed"),
        _count_if(F.col("status") == "skipped").alias("skipped"),
        F.coalesce(F.max(F.when(saved, F.col("depth"))), F.lit(0)).cast("bigint").alias("max_depth_reached"),
        F.coalesce(F.avg(F.when(saved, score)), F.lit(0.0)).alias("avg_score"),
    )


def depth_distribution(results: DataFrame) -> DataFrame:
    """A3 (row form): saved pages per ``(item_id, depth_N)``."""
    return (
        results.where(F.col("status") == "success")
        .groupBy("item_id", F.concat(F.lit("depth_"), F.col("depth").cast("string")).alias("depth_key"))
        .agg(F.count(F.lit(1)).alias("pages"))
    )


def run_urls(results: DataFrame) -> DataFrame:
    """A4 (row form): ``(item_id, position, url)`` of every reported page in
    ``(depth, url)`` order.  Positions are counted within a depth, a large one
    range by range, and moved by the pages of the depths before, so neither an
    item nor a depth of it is sorted as a whole."""
    sizes = results.groupBy("item_id", "depth").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("item_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("item_id", "depth", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    placed = ordinal_by_range(results.select("item_id", "depth", "url"), ["item_id", "depth"], "url", "place")
    return placed.join(offsets, ["item_id", "depth"]).select(
        "item_id", (F.col("before") + F.col("place")).cast("bigint").alias("position"), "url")


def run_summary(df: DataFrame, stages: dict[str, Column]) -> DataFrame:
    """One ``(stage, rows)`` line per named stage, each a count over the
    same rows: one aggregate, then unpivoted."""
    lines = [F.struct(F.lit(name).alias("stage"), F.col(f"__{i}").alias("rows")) for i, name in enumerate(stages)]
    counts = df.agg(*[c.cast("bigint").alias(f"__{i}") for i, c in enumerate(stages.values())])
    return counts.select(F.inline(F.array(*lines)))
