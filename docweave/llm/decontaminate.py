"""Benchmark decontamination by size-partitioned MinHash containment search.

An item and a document are sets of word shingles; a document is contaminated
by an item if it holds at least ``threshold`` of the item's shingles.  Items
are partitioned by the size of their sets (powers of two).  The sketch of an
item is its smallest shingle hashes, so many for each partition that a
document which holds ``threshold`` of the item must hold one of them: the
search loses nothing.  A document probes only hashes up to the largest sketch
hash of the partitions that are not too large for it.  Candidates are then
verified on the shingles themselves.

Built-in functions only.  Edge cases: a null text is empty; texts and items of
fewer than ``shingle`` words have no shingles and are never matched; repeated
documents or items give repeated result rows, null ids are kept as ids; empty
tables give an empty result; only the named columns are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from docweave.llm.common import shared_table, small_side

SHINGLE = 5
THRESHOLD = 0.8


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _each_shingle(n: int, make) -> Column:
    many = F.size("w")
    return F.when(many >= n, F.transform(F.sequence(F.lit(1), many - n + 1), lambda i: make(F.slice("w", i, n)))).otherwise(
        F.array().cast("array<bigint>" if make is F.xxhash64 else "array<string>"))


def needed(size: int, threshold: float) -> int:
    """Shared shingles that a set of ``size`` asks for."""
    return max(1, math.ceil(threshold * size - 1e-9))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", shingle: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, item_id, n_shared, n_item, containment)`` for each document
    and item with a containment of ``threshold`` or more."""
    joined = lambda s: F.array_join(s, " ")
    item = items.select(F.col(item_col).alias("item_id"), words(F.col(item_text_col)).alias("w"))
    item = item.select("item_id", F.array_distinct(_each_shingle(shingle, joined)).alias("grams")).where(F.size("grams") > 0)
    item = shared_table(item.select("item_id", "grams", F.ceil(F.log2(F.size("grams"))).cast("int").alias("part")), "items")

    # sketch sizes by partition: one more than the shingles that may be missing
    miss = lambda p: max(s - needed(s, threshold) for s in range((1 << p) // 2, (1 << p) + 1)) + 1
    parts = sorted(r["part"] for r in item.select("part").distinct().collect())  # at most 32 sizes
    if not parts:
        return docs.select(F.col(id_col).alias("doc_id"), F.lit(None).cast(items.schema[item_col].dataType).alias("item_id"),
                           F.lit(0).cast("long").alias("n_shared"), F.lit(0).cast("long").alias("n_item"),
                           F.lit(0.0).alias("containment")).where(F.lit(False))
    many = F.create_map(*[F.lit(x) for p in parts for x in (p, miss(p))])
    gram_hash = lambda g: F.xxhash64(F.split(g, " "))
    sketch = F.slice(F.array_sort(F.transform("grams", gram_hash)), F.lit(1), many[F.col("part")])
    index = shared_table(item.select("item_id", "part", F.explode(sketch).alias("h")), "sketches")
    bounds = {r["part"]: r["top"] for r in index.groupBy("part").agg(F.max("h").alias("top")).collect()}
    n_index, n_items = index.count(), item.count()

    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    hashes = base.select("doc_id", words(F.col("text")).alias("w")).select("doc_id", _each_shingle(shingle, F.xxhash64).alias("hs"))
    top = F.greatest(*[F.when(F.size("hs") >= needed(max(1, (1 << p) // 2), threshold), F.lit(bounds[p])) for p in parts], F.lit(-(1 << 63)))
    probes = hashes.select("doc_id", F.explode(F.filter("hs", lambda h: h <= top)).alias("h"))
    found = probes.join(small_side(index.select("h", "item_id"), n_index), "h").select("doc_id", "item_id").distinct()
    found = shared_table(found.groupBy("doc_id").agg(F.collect_set("item_id").alias("item_ids")), "candidates")

    near = base.join(found.withColumnRenamed("doc_id", "cand_id"), F.col("doc_id").eqNullSafe(F.col("cand_id")))
    near = near.select("doc_id", "item_ids", words(F.col("text")).alias("w"))
    near = near.select("doc_id", _each_shingle(shingle, joined).alias("doc_grams"), F.explode("item_ids").alias("item_id"))
    pairs = near.join(small_side(item.select("item_id", "grams"), n_items), "item_id").select(
        "doc_id", "item_id", F.size(F.array_intersect("grams", "doc_grams")).cast("long").alias("n_shared"),
        F.size("grams").cast("long").alias("n_item"))
    pairs = pairs.withColumn("containment", F.col("n_shared") / F.col("n_item"))
    return pairs.where(F.col("n_shared") >= F.ceil(threshold * F.col("n_item") - 1e-9))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` (all columns) that no item contaminates."""
    # a row is known by its id and text: ids may be null or stand for several texts;
    # it travels in a struct, so its columns may have any names
    key = F.struct(F.col(f"row.`{id_col}`").alias("id"), F.xxhash64(F.coalesce(F.col(f"row.`{text_col}`"), F.lit(""))).alias("text"))
    rows = docs.select(F.struct("*").alias("row")).withColumn("key", key)
    bad = contamination(rows.select("key", F.col(f"row.`{text_col}`").alias("text")), items, "key", "text", **options)
    bad = bad.select(F.col("doc_id").alias("bad")).distinct()
    return rows.join(bad, F.col("key").eqNullSafe(F.col("bad")), "left_anti").select("row.*")


ORACLE = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) AS g FROM d),
bs AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) AS g FROM b),
n AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id),
m AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN bs USING (g) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment
FROM m JOIN n USING (item_id) WHERE n_shared >= ceil(0.8 * n_item - 1e-9)
"""
