"""SimHash near-dedup over a Gray-order hierarchical index.

Documents become 64-bit SimHash fingerprints.  Equal fingerprints are one
entry.  An entry is filed once under each of ``max_bits + 1`` masked bit
patterns (two fingerprints within ``max_bits`` agree on at least one of
them).  The entries of a pattern are sorted by Gray rank, so neighbours share
most bits; groups of neighbours keep the bits that all of them share as a
masked pattern, groups of groups likewise.  A search walks pairs of groups
from the top and drops a pair as soon as the differences of the shared bits
exceed the bound.  Matches inside a pattern are reduced to spanning links, so
a dense group never writes all its pairs.  A pattern that holds more than
``bucket_rows`` entries is filed again under longer patterns until it fits,
which is exact for the same reason as the first filing.

Edge cases: a null text is empty; no words give the fingerprint zero, which
links like any other; rows that repeat an id or a text share their
component; a null id is never the name of a component (null if the component
has no other).  An empty table gives an empty result.  Only the named id and
text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from docweave.llm.common import passing_tables, run_starts, shared_table, sorted_runs, staying_table, texts, union_all, utf8
from docweave.llm.graph import components

BITS = 64
FANOUT = 16
SEED = 42
#: Distinct fingerprints that one task searches under one masked pattern.
BUCKET_ROWS = 4096
#: Pairs of groups that one step of a search holds.
FRONTIER = 200_000


def text_fingerprint(raw: bytes, shingle: int) -> int:
    """SimHash of a text: words are runs of non-space bytes, A-Z lower-cased;
    a bit is set if over half of the shingle hashes set it (0 without words)."""
    words = raw.lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_digest
    if len(words) <= shingle:
        return int.from_bytes(digest(b" ".join(words), SEED), "big")
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends[:-shingle + 1 or None] - np.fromiter(map(len, words[:len(words) - shingle + 1]), np.int64) - 1).tolist()
    stops = (ends[shingle - 1:] - 1).tolist()
    hashes = b"".join([digest(joined[s:e], SEED) for s, e in zip(starts, stops)])
    ones = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(stops)).tobytes(), "big")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(doc_id, fp)``: one signed 64-bit fingerprint for each row."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            fps = np.array([text_fingerprint(utf8(t), shingle) for t in f["text"]], np.uint64)
            yield pd.DataFrame({"doc_id": f["doc_id"], "fp": fps.view(np.int64)})

    return texts(df, id_col, text_col).mapInPandas(run, "doc_id long, fp long")


def gray_rank(code: Column) -> Column:
    """Rank of a 64-bit code in the reflected Gray sequence."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code


def unsigned_order(value: Column) -> Column:
    """A signed long that sorts as the unsigned value does."""
    return value.bitwiseXOR(F.lit(-(1 << 63)))


def split_mask(free: int, parts: int) -> list[int]:
    """Cut the set bits of ``free`` into ``parts`` masks of consecutive bits."""
    bits = [b for b in range(BITS) if free >> b & 1]
    cuts = [len(bits) * i // parts for i in range(parts + 1)]
    return [sum(1 << b for b in bits[lo:hi]) for lo, hi in zip(cuts, cuts[1:])]


def signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


class GrayIndex:
    """Hierarchy over fingerprints sorted by (bucket, Gray rank).

    Level 0 holds single fingerprints; an entry of a higher level covers up to
    ``FANOUT`` consecutive entries of the level below and of the same bucket,
    with the bits (``mask``) on which all of them agree (``pattern``).
    """

    def __init__(self, buckets: np.ndarray, fps: np.ndarray):
        ones = np.full(len(fps), np.iinfo(np.uint64).max, np.uint64)
        self.levels = [(fps, ones)]
        self.children: list[tuple[np.ndarray, np.ndarray]] = []
        bucket = buckets
        starts = run_starts(buckets)
        #: buckets with two entries or more; a lone entry has nothing to meet
        self.shared = np.flatnonzero(np.diff(np.append(starts, len(buckets))) > 1)
        while True:
            starts = run_starts(bucket)
            sizes = np.diff(np.append(starts, len(bucket)))
            if not len(sizes) or sizes.max() == 1:
                break
            within = np.arange(len(bucket)) - np.repeat(starts, sizes)
            first = np.flatnonzero(within % FANOUT == 0)
            pattern, mask = self.levels[-1]
            head = np.repeat(pattern[first], np.diff(np.append(first, len(bucket))))
            odd = np.bitwise_or.reduceat((pattern ^ head) | ~mask, first)
            self.levels.append((pattern[first] & ~odd, ~odd))
            self.children.append((first, np.append(first[1:], len(bucket))))
            bucket = bucket[first]

    def matches(self, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Index pairs ``i < j`` of one bucket that differ in ``max_bits`` bits or fewer, in blocks."""
        top = len(self.levels) - 1
        if top == 0:
            return
        work = [(top, self.shared, self.shared)]
        while work:
            level, a, b = work.pop()
            if level:
                first, last = self.children[level - 1]
                na, nb = last[a] - first[a], last[b] - first[b]
                total = na * nb
                if len(a) > 1 and total.sum() > FRONTIER:
                    half = len(a) // 2
                    work += [(level, a[:half], b[:half]), (level, a[half:], b[half:])]
                    continue
                at = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
                wide = np.repeat(nb, total)
                x = np.repeat(first[a], total) + at // wide
                y = np.repeat(first[b], total) + at % wide
                level -= 1
                pattern, mask = self.levels[level]
                near = x < y if level == 0 else x <= y
                near &= np.bitwise_count((pattern[x] ^ pattern[y]) & mask[x] & mask[y]) <= max_bits
                work.append((level, x[near], y[near]))
            elif len(a):
                yield a, b


class Links:
    """Union-find over array positions that keeps only spanning links."""

    def __init__(self, n: int):
        self.parent = np.arange(n)
        self.kept: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        p = self.parent
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    def flatten(self) -> None:
        while True:
            up = self.parent[self.parent]
            if (up == self.parent).all():
                return
            self.parent = up

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.flatten()
        open_ = self.parent[a] != self.parent[b]
        for i, j in zip(a[open_].tolist(), b[open_].tolist()):
            x, y = self.find(i), self.find(j)
            if x != y:
                self.parent[max(x, y)] = min(x, y)
                self.kept.append((i, j))


def filed(fps: DataFrame, max_bits: int, bucket_rows: int) -> DataFrame:
    """The entries ``(fp, ...)`` under masked patterns ``(mask, val)`` of at most
    ``bucket_rows`` entries, refined while a pattern holds more."""
    carried = fps.columns
    parts = max_bits + 1
    full = (1 << BITS) - 1

    def under(df: DataFrame, masks) -> DataFrame:
        return df.select(*carried, F.explode(masks).alias("mask")).select(
            *carried, "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("val"))

    as_array = lambda masks: F.array(*[F.lit(signed(m)) for m in masks])
    masks = split_mask(full, parts)
    rows = under(fps, as_array(masks))
    done: list[DataFrame] = []
    while True:
        hot = shared_table(rows.groupBy("mask", "val").count().where(F.col("count") > bucket_rows).select("mask", "val"), "hot")
        here = {r["mask"] for r in hot.select("mask").distinct().collect()}  # at most len(masks)
        finer = {m: [m | s for s in split_mask(full & ~m, parts) if s] for m in masks if signed(m) in here}
        if not any(finer.values()):
            done.append(rows)
            break
        done.append(rows.join(hot, ["mask", "val"], "left_anti").select(*carried, "mask", "val"))
        rows = rows.join(hot, ["mask", "val"], "left_semi")
        by_mask = F.create_map(*[x for m, subs in finer.items() for x in (F.lit(signed(m)), as_array(subs))])
        rows = shared_table(under(rows, F.element_at(by_mask, F.col("mask"))), "filed")
        masks = sorted({s for subs in finer.values() for s in subs})
    return union_all(done)


def fingerprint_links(fps: DataFrame, max_bits: int = 2, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Spanning links ``(a, b)`` of distinct fingerprints within ``max_bits`` bits."""

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in sorted_runs(frames, ["mask", "val"]):
            fp = f["fp"].to_numpy(np.int64)
            starts = run_starts(f["mask"].to_numpy(), f["val"].to_numpy())
            bucket = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(f))))
            links = Links(len(f))
            for a, b in GrayIndex(bucket, fp.view(np.uint64)).matches(max_bits):
                links.add(a, b)
            if links.kept:
                a, b = np.array(links.kept).T
                yield pd.DataFrame({"a": fp[a], "b": fp[b]})

    rows = filed(fps, max_bits, bucket_rows).withColumn("rank", unsigned_order(gray_rank(F.col("fp"))))
    rows = rows.repartition("mask", "val").sortWithinPartitions("mask", "val", "rank")
    return rows.select("mask", "val", "fp").mapInPandas(search, "a long, b long")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 2, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``(doc_id, fp, component_id)`` for each row; ``component_id`` is the
    least id among all documents linked directly or through others."""
    rows = shared_table(fingerprints(df, id_col, text_col, shingle), "fingerprints")
    # map-side partial counts collapse copies before any row is moved
    entries = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    comp = components(fingerprint_links(entries.select("fp"), max_bits, bucket_rows))
    named = entries.join(comp, entries.fp == comp.node, "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component"))
    ids = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_fp = named.join(ids, "component").select("fp", "component_id")
    return rows.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``df`` (all columns) with one document of each group: the
    least id (a null id only if there is no other), ties by text hash.  A row is
    known by its id and text: one id may stand for several texts."""
    th = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    with passing_tables(df.sparkSession):
        fps = fingerprints_by_text(df.select(th.alias("_th"), F.col(text_col)), text_col, options.get("shingle", 3))
        fps = shared_table(fps.groupBy("_th").agg(F.min("fp").alias("fp")), "fingerprints")
        entries = fps.select("fp").distinct()
        comp = components(fingerprint_links(entries, options.get("max_bits", 2), options.get("bucket_rows", BUCKET_ROWS)))
        named = entries.join(comp, entries.fp == comp.node, "left").select("fp", F.coalesce("component", "fp").alias("component"))
        # the least id of each text (nulls last), then the least of these in each component
        first = df.select(th.alias("_th"), F.col(id_col).alias("id")).groupBy("_th").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id")).alias("at"))
        least = first.join(fps, "_th").join(named, "fp").groupBy("component").agg(F.min(F.struct("at.none", "at.id", "_th")).alias("kept"))
        least = staying_table(least.select(F.struct("kept.id", F.col("kept._th").alias("th")).alias("key")), "kept")
    # a row travels in a struct, so its columns may have any names; its key is one column, in
    # which nulls are equal, so that join and removal of copies share one shuffle of the rows
    rows = df.select(F.struct("*").alias("row"), F.struct(F.col(id_col).alias("id"), th.alias("th")).cast(least.schema["key"].dataType).alias("key"))
    return rows.join(least, "key", "left_semi").dropDuplicates(["key"]).select("row.*")


def fingerprints_by_text(df: DataFrame, text_col: str, shingle: int) -> DataFrame:
    """``(_th, fp)``: fingerprints with the text hash in place of an id."""
    return fingerprints(df, "_th", text_col, shingle).withColumnRenamed("doc_id", "_th")


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
