"""Exact repeated byte strings: maximal repeat groups from a suffix array.

A byte string of ``length`` bytes that starts at two places contains, at the
same offset, the least hash of its ``SEED_BYTES``-byte substrings (its
anchor).  So suffixes are indexed at anchors only, and suffixes of one anchor
form a bucket of the enhanced suffix array.  Each suffix carries its context:
up to ``length - SEED_BYTES`` bytes to the left and ``length`` to the right,
all that a string of ``length`` bytes through the anchor can touch.

* Equal contexts are one class, counted before rows are moved; a class with
  several occurrences is a repeat group as it stands.
* A bucket with several classes is sorted by right context.  A stack scan over
  its common prefixes gives the interval tree; in each interval the left
  contexts are sorted and scanned likewise.  A node of both trees whose left
  and right extensions reach ``length`` bytes, with diverse next bytes on
  both sides, is a maximal repeat (within the context) with all its
  occurrences.
* A bucket with more than ``bucket_rows`` classes is cut by where the string
  starts before the anchor: each half shares longer bytes, which become its
  key.  This goes on until the buckets fit or one start remains, where the
  members share the whole string.

Repeats longer than a context come out as overlapping groups, one for each
anchor.  Edge cases: null texts are empty; texts shorter than ``length`` have
no repeats; repeated rows are occurrences of their own; a null id is read as
an id made from the text; a row is known by its id and the hash of its text
(``uid``, ``th``), so several texts may share an id; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from docweave.llm.common import run_starts, shared_table, sorted_runs, union_all, utf8, with_uid

LENGTH = 200
SEED_BYTES = 64
#: Contexts that one task scans as one bucket (about 11 MB of them).
BUCKET_ROWS = 32_768
SEGMENT = 1 << 20
INDEX_BITS = 21
ROWS = "uid long, th long, a long, c long, pos long, l int, r int"

_BASE = 0x9E3779B97F4A7C15
_MIX = 0xBF58476D1CE4E5B9
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_byte_values = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256, dtype=np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    size = 1 << max(12, n.bit_length())
    if size not in _powers:
        tables = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            t = np.full(size, base, np.uint64)
            t[0] = 1
            tables.append(np.cumprod(t, dtype=np.uint64))
        _powers[size] = (tables[0], tables[1])
    return _powers[size]


def substring_hashes(raw: bytes, k: int) -> np.ndarray:
    """Hash of the ``k`` bytes from each position (rolling polynomial, mixed)."""
    values = _byte_values[np.frombuffer(raw, np.uint8)]
    up, down = _power_tables(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(values * up[:len(raw)], out=sums[1:])
    h = (sums[k:] - sums[:-k]) * down[:len(raw) - k + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(_MIX)
    h ^= h >> np.uint64(32)
    return h


def _window_least(keys: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive keys: prefix and suffix minima of blocks."""
    n = len(keys)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def anchors(raw: bytes, length: int = LENGTH, k: int = SEED_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of all strings of ``length`` bytes."""
    places, hashes, last = [], [], -1
    low = np.uint64((1 << INDEX_BITS) - 1)
    for at in range(0, max(0, len(raw) - length + 1), SEGMENT):
        h = substring_hashes(raw[at:at + SEGMENT + length - 1], k)
        keys = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        where = (_window_least(keys, length - k + 1) & low).astype(np.int64)
        where = where[run_starts(where)]
        where = where[where + at > last]
        if len(where):
            last = int(where[-1]) + at
            places.append(where + at)
            hashes.append(h[where].view(np.int64))
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(places), np.concatenate(hashes)


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def prefix_intervals(shared: list[int]) -> Iterator[tuple[int, int, int]]:
    """Stack scan: ``shared[i]`` is the common prefix of sorted items ``i`` and
    ``i + 1``; gives (depth, first, last) of every node with two items or more."""
    stack: list[tuple[int, int]] = []
    for i in range(len(shared) + 1):
        depth = shared[i] if i < len(shared) else -1
        first = i
        while stack and stack[-1][0] > depth:
            d, first = stack.pop()
            yield d, first, i
        if depth >= 0 and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


def repeat_groups(contexts: list[bytes], lefts: list[int], length: int, lo: int, hi: int):
    """Maximal repeats among suffix contexts of one bucket whose strings start
    ``lo`` to ``hi`` bytes before the anchor: (left, right, member indexes)."""
    right = [c[n:n + length - lo] for c, n in zip(contexts, lefts)]
    left = [c[max(0, n - hi):n][::-1] for c, n in zip(contexts, lefts)]
    if len(contexts) == 2:
        e, d = common_prefix(*left), common_prefix(*right)
        if e + d >= length:
            yield e, d, [0, 1]
        return
    order = sorted(range(len(right)), key=right.__getitem__)
    shared = [common_prefix(right[x], right[y]) for x, y in zip(order, order[1:])]
    at_depth: dict[int, list[int]] = {}
    for i, d in enumerate(shared):
        at_depth.setdefault(d, []).append(i)
    rank = {x: i for i, x in enumerate(order)}
    for depth, first, last in prefix_intervals(shared):
        need = length - depth
        members = sorted((x for x in order[first:last + 1] if len(left[x]) >= need), key=left.__getitem__)
        if len(members) < 2:
            continue
        behind = [common_prefix(left[x], left[y]) for x, y in zip(members, members[1:])]
        for e, x, y in prefix_intervals(behind):
            if e < need:
                continue
            group = members[x:y + 1]
            ranks = [rank[g] for g in group]
            breaks = at_depth[depth]
            # diverse to the right: two members stand on both sides of a break
            i = bisect_right(breaks, min(ranks) - 1)
            if i < len(breaks) and breaks[i] < max(ranks):
                yield e, depth, group


def _docs(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return with_uid(df, id_col, text_col).withColumn("th", F.xxhash64("text"))


def suffixes(docs: DataFrame, length: int) -> DataFrame:
    """``(uid, th, a, c, pos, l, r)``: anchor, context hash, place and context extents."""
    reach = length - SEED_BYTES

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = {n: [] for n in ("uid", "th", "a", "c", "pos", "l", "r")}
            for uid, th, text in zip(f["uid"].tolist(), f["th"].tolist(), f["text"]):
                raw = utf8(text)
                pos, a = anchors(raw, length)
                if not len(pos):
                    continue
                l, r = np.minimum(pos, reach), np.minimum(len(raw) - pos, length)
                c = [xxhash.xxh64_intdigest(raw[p - x:p + y], x) for p, x, y in zip(pos.tolist(), l.tolist(), r.tolist())]
                for name, value in zip(out, (np.full(len(pos), uid), np.full(len(pos), th), a, np.array(c, np.uint64).view(np.int64), pos, l, r)):
                    out[name].append(value)
            if out["uid"]:
                yield pd.DataFrame({n: np.concatenate(v) for n, v in out.items()})

    return docs.select("uid", "th", "text").mapInPandas(run, ROWS)


def _contexts(need: DataFrame, docs: DataFrame) -> DataFrame:
    """Context bytes of the class representatives, cut from their texts."""
    wanted = need.groupBy("uid", "th").agg(F.collect_list(F.struct("a", "c", "pos", "l", "r")).alias("wanted"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for text, want in zip(f["text"], f["wanted"]):
                raw = utf8(text)
                rows += [(w["a"], w["c"], raw[w["pos"] - w["l"]:w["pos"] + w["r"]], w["l"]) for w in want]
                if len(rows) > 20_000:
                    yield pd.DataFrame(rows, columns=["a", "c", "ctx", "l"])
                    rows = []
            yield pd.DataFrame(rows, columns=["a", "c", "ctx", "l"])

    cut = docs.join(wanted, ["uid", "th"]).select("text", "wanted").mapInPandas(run, "a long, c long, ctx binary, l int")
    return cut.dropDuplicates(["a", "c"])  # a repeated row gives its contexts again


def _scan(rows: DataFrame, length: int, members: bool) -> DataFrame:
    """Repeat groups of the buckets ``key``, each scanned in one task: a row for
    each member of each group, or only each suffix's largest extents."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in sorted_runs(frames, ["key"], 10_000):
            starts = run_starts(f["key"].to_numpy())
            stops = np.append(starts[1:], len(f))
            ctx, l, a, c = f["ctx"].tolist(), f["l"].tolist(), f["a"].to_numpy(), f["c"].to_numpy()
            lo, hi = f["lo"].tolist(), f["hi"].tolist()
            far = np.zeros((2, len(f)), np.int32)
            names, at, ends = [], [], []
            for s, t in zip(starts[stops - starts > 1].tolist(), stops[stops - starts > 1].tolist()):
                for e, d, group in repeat_groups(ctx[s:t], l[s:t], length, lo[s], hi[s]):
                    own = np.array(group) + s
                    if members:
                        x = own[0]
                        names += [xxhash.xxh64_intdigest(ctx[x][l[x] - e:l[x] + d]) - (1 << 63)] * len(own)
                        at.append(own)
                        ends += [(e, d)] * len(own)
                    far[0, own] = np.maximum(far[0, own], e)
                    far[1, own] = np.maximum(far[1, own], d)
            if members and at:
                own = np.concatenate(at)
                e, d = np.array(ends).T
                yield pd.DataFrame({"repeat_id": names, "a": a[own], "c": c[own], "e": e, "d": d})
            elif not members:
                own = np.flatnonzero(far[1])
                yield pd.DataFrame({"repeat_id": 0, "a": a[own], "c": c[own], "e": far[0, own], "d": far[1, own]})

    rows = rows.repartition("key").sortWithinPartitions("key")
    return rows.select("key", "ctx", "l", "a", "c", "lo", "hi").mapInPandas(run, "repeat_id long, a long, c long, e int, d int")


def _bucket_groups(ctx: DataFrame, length: int, bucket_rows: int, members: bool) -> DataFrame:
    """Repeat groups of all buckets; buckets over ``bucket_rows`` are cut until they fit."""
    rows = ctx.select(F.col("a").alias("key"), F.lit(0).alias("lo"), F.lit(length - SEED_BYTES).alias("hi"), "a", "c", "ctx", "l")
    fit, ends = [], []
    while True:
        hot = shared_table(rows.groupBy("key", "lo", "hi").count().where(F.col("count") > bucket_rows).select("key", "lo", "hi"), "hot")
        if hot.isEmpty():
            fit.append(rows)
            break
        fit.append(rows.join(hot.select("key"), "key", "left_anti"))
        rows = rows.join(hot.select("key"), "key", "left_semi")
        # one start left: the members share the whole string
        ends.append(rows.where("lo = hi").select(F.col("key").alias("repeat_id"), "a", "c", F.col("lo").alias("e"),
                                                 (length - F.col("lo")).alias("d")))
        mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        halves = F.array(F.struct(F.col("lo").alias("lo"), mid.alias("hi")), F.struct((mid + 1).alias("lo"), F.col("hi").alias("hi")))
        rows = rows.where("lo < hi").select("a", "c", "ctx", "l", F.explode(halves).alias("h")).select("a", "c", "ctx", "l", "h.lo", "h.hi")
        rows = rows.where(F.expr(f"l >= lo AND length(ctx) - l >= {length} - hi"))
        core = F.expr(f"substring(ctx, l - lo + 1, lo + {length} - hi)")
        rows = shared_table(rows.select(F.xxhash64("a", "lo", "hi", core).alias("key"), "lo", "hi", "a", "c", "ctx", "l"), "cut")
    return union_all([_scan(part, length, members) for part in fit] + ends)


def _indexed(df: DataFrame, id_col: str, text_col: str, length: int, members: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Suffixes at shared anchors, their classes with several occurrences as
    groups, and the contexts of the buckets that have to be scanned: all with
    several classes for ``members``; for spans those with a class of one
    occurrence, as the others are covered by their own groups."""
    docs = _docs(df, id_col, text_col)
    rows = suffixes(docs, length)
    shared = shared_table(rows.groupBy("a").count().where("count > 1").select("a"), "anchors")
    dup = shared_table(rows.join(shared, "a", "left_semi"), "suffixes")
    classes = shared_table(dup.groupBy("a", "c").agg(
        F.count("*").alias("n"), F.min(F.struct("uid", "th", "pos", "l", "r")).alias("at")), "classes")
    buckets = classes.groupBy("a").agg(F.count("*").alias("k"), F.min("n").alias("least"))
    buckets = buckets.where("k > 1" if members else "k > 1 AND least = 1").select("a")
    buckets = shared_table(buckets, "buckets")
    need = classes.join(buckets, "a", "left_semi").select("a", "c", "at.*")
    ctx = shared_table(_contexts(need, docs), "contexts")
    whole = classes.where("n > 1").select(F.xxhash64("a", "c").alias("repeat_id"), "a", "c", F.col("at.l").alias("e"), F.col("at.r").alias("d"))
    return dup, whole, ctx


def repeat_occurrences(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                       bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``(repeat_id, uid, th, start, length)``: every occurrence of every maximal
    repeat group of ``length`` bytes or more (bytes of the UTF-8 text)."""
    dup, whole, ctx = _indexed(df, id_col, text_col, length, True)
    groups = shared_table(whole.unionByName(_bucket_groups(ctx, length, bucket_rows, True)), "groups")
    return groups.join(dup.select("a", "c", "uid", "th", "pos"), ["a", "c"]).select(
        "repeat_id", "uid", "th", (F.col("pos") - F.col("e")).alias("start"), (F.col("e") + F.col("d")).alias("length"))


def repeat_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                 bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``(uid, th, start, length)``: for each suffix the union of the groups it is a
    member of (all of them hold its anchor, so the union is one span)."""
    dup, whole, ctx = _indexed(df, id_col, text_col, length, False)
    groups = whole.unionByName(_bucket_groups(ctx, length, bucket_rows, False))
    extents = shared_table(groups.groupBy("a", "c").agg(F.max("e").alias("e"), F.max("d").alias("d")), "extents")
    return extents.join(dup.select("a", "c", "uid", "th", "pos"), ["a", "c"]).select(
        "uid", "th", (F.col("pos") - F.col("e")).alias("start"), (F.col("e") + F.col("d")).alias("length"))


def merge_spans(starts: np.ndarray, stops: np.ndarray) -> list[tuple[int, int]]:
    """Union of half-open spans as maximal runs."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(stops[order])
    new = np.append(True, starts[1:] > reach[:-1])
    first = np.flatnonzero(new)
    return list(zip(starts[first].tolist(), reach[np.append(first[1:] - 1, len(starts) - 1)].tolist()))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Each row's bytes without its repeats: ``(doc_id, n_bytes, n_removed,
    n_spans, spans array<struct<start, stop>>, kept binary)``."""
    docs = _docs(df, id_col, text_col)
    found = repeat_spans(df, id_col, text_col, length, bucket_rows)
    spans = found.groupBy("uid", "th").agg(F.collect_list(F.struct("start", "length")).alias("found"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for doc_id, text, found in zip(f["doc_id"], f["text"], f["found"]):
                raw, runs = utf8(text), []
                if found is not None and len(found):
                    s = np.array([x["start"] for x in found], np.int64)
                    runs = merge_spans(s, s + np.array([x["length"] for x in found], np.int64))
                edges = [0, *(x for run in runs for x in run), len(raw)]
                kept = b"".join(raw[s:e] for s, e in zip(edges[::2], edges[1::2]))
                rows.append((doc_id, len(raw), len(raw) - len(kept), len(runs), [{"start": s, "stop": e} for s, e in runs], kept))
            out = pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"])
            yield out.astype({"doc_id": "Int64"})

    return docs.join(spans, ["uid", "th"], "left").select("doc_id", "text", "found").mapInPandas(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<struct<start: long, stop: long>>, kept binary")
