"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is a set of digests: paragraphs (lines), cut into pieces of ``SHORT``
words at their head and ``LONG`` words after it; a piece that comes again is
digested with its number.  Each digest goes to one cell in each of three
sub-tables; a cell holds a count, the XOR of the digests and the XOR of their
checks.  Two sketches of one size subtract cell by cell, and peeling cells
with a single digest recovers the digests in which two versions differ.  If
peeling stops early, both texts are sketched again ``GROW`` times larger.
Likeness is one less the share of differing digests.

The next document (ascending id) is found without a global sort: ids are cut
into ranges at sampled quantiles, the first document of each range is also
dealt to the range before it, and each sorted range is read as a stream by a
task of its own, which takes the differences of some hundred documents at once.

Edge cases: a null text is empty, an empty text has an empty sketch (two of
them are alike: 1.0); equal ids are ordered by
text hash; null ids come first; the
last document is followed by the first, a single one by itself; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from docweave.llm.common import run_starts, texts, utf8

CELLS = 30  # of the stored fingerprint; a multiple of 3
GROW = 4
#: Cells of the sketches that are subtracted together; rows (and signs of their texts) that a task holds.
MOST_CELLS, ROWS, SIGNS = 1 << 16, 256, 4 << 20
SHORT, LONG, HEAD = 8, 32, 32
_SPREAD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def digests(text: str) -> np.ndarray:
    """Digests of the pieces of a text, as a set."""
    seen: dict[bytes, int] = {}
    out = []
    for line in utf8(text).split(b"\n"):
        words = line.split()
        at = 0
        while at < len(words):
            step = SHORT if at < HEAD else LONG
            piece = b" ".join(words[at:at + step])
            n = seen[piece] = seen.get(piece, -1) + 1
            out.append(xxhash.xxh64_intdigest(piece, n))
            at += step
    return np.unique(np.array(out, np.uint64))


def _checks(keys: np.ndarray) -> np.ndarray:
    h = (keys ^ (keys >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h ^ (h >> np.uint64(29))) >> np.uint64(32)


def _cells(keys: np.ndarray, size: int) -> np.ndarray:
    """Cell numbers ``(3, n)``: one in each third of the table."""
    third = np.uint64(size // 3)
    mixed = keys[None, :] * _SPREAD[:, None]
    return ((mixed ^ (mixed >> np.uint64(32))) % third + (np.arange(3, dtype=np.uint64) * third)[:, None]).astype(np.int64)


class Sketches:
    """Count, digest XOR and check XOR of each cell of many sketches of one size, a row each."""

    def __init__(self, count: np.ndarray, key: np.ndarray, check: np.ndarray):
        self.count, self.key, self.check = count, key, check

    @classmethod
    def of(cls, sets: list[np.ndarray], size: int) -> Sketches:
        keys, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(k) for k in sets])
        at = (_cells(keys, size) + row * size).ravel()
        key, check = np.zeros(len(sets) * size, np.uint64), np.zeros(len(sets) * size, np.uint64)
        np.bitwise_xor.at(key, at, np.tile(keys, 3))
        np.bitwise_xor.at(check, at, np.tile(_checks(keys), 3))
        shape = len(sets), size
        return cls(np.bincount(at, minlength=key.size).reshape(shape), key.reshape(shape), check.reshape(shape))

    def minus(self, other: Sketches) -> Sketches:
        return Sketches(self.count - other.count, self.key ^ other.key, self.check ^ other.check)

    def peel(self) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Of each row the digests only in the first and only in the second version; None if peeling stops early."""
        rows, size = self.count.shape
        count, key, check = (x.reshape(-1).copy() for x in (self.count, self.key, self.check))
        row, gone, signs = ([np.zeros(0, kind)] for kind in (np.int64, np.uint64, np.int64))
        look = np.arange(rows * size)
        while True:
            pure = look[np.abs(count[look]) == 1]
            pure = pure[_checks(key[pure]) == check[pure]]
            if not len(pure):
                break
            order = np.lexsort((pure, key[pure], pure // size))
            pure = pure[order]
            keys, own = key[pure], pure // size
            first = run_starts(own, keys)
            keys, own, sign = keys[first], own[first], count[pure[first]]
            at = (_cells(keys, size) + own * size).ravel()
            np.bitwise_xor.at(key, at, np.tile(keys, 3))
            np.bitwise_xor.at(check, at, np.tile(_checks(keys), 3))
            np.subtract.at(count, at, np.tile(sign, 3))
            row.append(own)
            gone.append(keys)
            signs.append(sign)
            look = np.unique(at)  # other cells stay as they are
        left = (count != 0).reshape(rows, size).any(axis=1) | (key != 0).reshape(rows, size).any(axis=1)
        own, keys, sign = (np.concatenate(x) for x in (row, gone, signs))
        order = np.lexsort((sign, own))
        ends = np.cumsum(np.bincount(2 * own + (sign > 0), minlength=2 * rows))[:-1]
        parts = np.split(keys[order], ends)
        return [None if left[i] else (parts[2 * i + 1], parts[2 * i]) for i in range(rows)]


class Version:
    """A text's digests."""

    def __init__(self, text: str):
        self.keys = digests(text)

    def fingerprint(self) -> str:
        return fingerprints([self])[0]


def fingerprints(versions: list[Version]) -> list[str]:
    """The number of digests and the sketch of ``CELLS`` cells of each version."""
    s = Sketches.of([v.keys for v in versions], CELLS)
    cells = np.empty(s.count.shape, [("count", ">i4"), ("key", ">u8"), ("check", ">u4")])
    cells["count"], cells["key"], cells["check"] = s.count, s.key, s.check
    return [base64.b64encode(struct.pack(">I", len(v.keys)) + c.tobytes()).decode() for v, c in zip(versions, cells)]


def differences(pairs: list[tuple[Version, Version]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Digests only in the first and only in the second version of each pair, by subtracting and
    peeling sketches; pairs of one size are gone through together."""
    out: list = [None] * len(pairs)
    open_: dict[int, list[int]] = {}
    for i, (a, b) in enumerate(pairs):
        size = CELLS
        least = 1.3 * abs(len(a.keys) - len(b.keys))  # fewer cells can't hold the difference
        while size < least:
            size *= GROW
        open_.setdefault(size, []).append(i)
    while open_:
        size = min(open_)
        waiting, step = open_.pop(size), max(1, MOST_CELLS // size)
        for some in (waiting[k:k + step] for k in range(0, len(waiting), step)):
            one, two = (Sketches.of([pairs[i][side].keys for i in some], size) for side in (0, 1))
            for i, found in zip(some, one.minus(two).peel()):
                if found is None:
                    open_.setdefault(size * GROW, []).append(i)
                out[i] = found
    return out


def difference(a: Version, b: Version) -> tuple[np.ndarray, np.ndarray]:
    return differences([(a, b)])[0]


def likenesses(pairs: list[tuple[Version, Version]]) -> list[float]:
    out = []
    for (a, b), found in zip(pairs, differences(pairs)):
        both = len(a.keys) + len(b.keys)
        out.append(1.0 - sum(map(len, found)) / both if both else 1.0)
    return out


def edited(text: str, following: str) -> str:
    """The last half of ``text`` replaced by as many first signs of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def in_order(docs: DataFrame) -> DataFrame:
    """``(block, extra, doc_id, text)``: id ranges, each with the document that follows it (``extra``)."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = np.array(docs.where("doc_id IS NOT NULL").approxQuantile("doc_id", [i / n for i in range(1, n)], 0.1 / n) if n > 1 else [])
    cuts = np.unique(cuts)  # as many as shuffle partitions

    @F.pandas_udf("int")
    def block_of(doc_id: pd.Series) -> pd.Series:
        known = np.searchsorted(cuts, doc_id.fillna(0).to_numpy(), side="right")
        return pd.Series(np.where(doc_id.isna(), 0, known).astype(np.int32))

    rows = docs.withColumn("block", block_of("doc_id")).withColumn("t", F.xxhash64("text"))
    # the first document of a range is its least (id, text hash); a null id is below all others
    heads = sorted((r["block"], r["h"]) for r in rows.groupBy("block").agg(F.min(F.struct("doc_id", "t")).alias("h")).collect())
    if not heads:
        return rows.select("block", F.lit(False).alias("extra"), "doc_id", "text")
    first, before = dict(heads), {b: heads[i - 1][0] for i, (b, _) in enumerate(heads)}
    upto = range(heads[-1][0] + 1)
    at_block = lambda kind, values: F.get(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("block"))
    is_head = F.col("doc_id").eqNullSafe(at_block("long", [first[b]["doc_id"] if b in first else None for b in upto])) & (
        F.col("t") == at_block("long", [first[b]["t"] if b in first else None for b in upto]))
    dealt = F.array_compact(F.array(
        F.struct(F.col("block").alias("b"), F.lit(False).alias("extra")),
        F.when(is_head, F.struct(at_block("int", [before.get(b) for b in upto]).alias("b"), F.lit(True).alias("extra")))))
    return rows.select("doc_id", "text", F.explode(dealt).alias("d")).select(F.col("d.b").alias("block"), "d.extra", "doc_id", "text")


def fingerprint_versions(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next)`` for each row."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def made(held: list[tuple]) -> pd.DataFrame:
        """Rows of ``(doc_id, text, own version, next text, next version)``."""
        changed = [edited(text, following) for _, text, _, following, _ in held]
        own, other, after = [h[2] for h in held], [Version(t) for t in changed], [h[4] for h in held]
        near = likenesses([*zip(own, other), *zip(own, after)])
        prints = fingerprints(own + other)
        n = len(held)
        hashes = [hashlib.sha256(utf8(t)).hexdigest() for t in changed]
        rows = zip((h[0] for h in held), (len(h[1]) for h in held), hashes, prints[:n], prints[n:], near[:n], near[n:])
        return pd.DataFrame(list(rows), columns=names).astype({"doc_id": "Int64"})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, before, ended = None, None, False
        held, signs = [], 0
        for f in frames:
            for b, extra, doc_id, text in zip(f["block"], f["extra"], f["doc_id"], f["text"]):
                if b != block:
                    block, before, ended = b, None, False
                if ended:
                    continue  # the following document came more than once (repeated rows)
                now = Version(text)
                if before is not None:
                    held.append((*before, text, now))
                    signs += len(text)
                before, ended = (doc_id, text, now), bool(extra)
                if len(held) >= ROWS or signs >= SIGNS:
                    yield made(held)
                    held, signs = [], 0
        if held:
            yield made(held)

    rows = in_order(texts(df, id_col, text_col))
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a task each: ranges are about equally large
    # within a range: its documents in order, then the one that follows it
    rows = rows.repartitionById(ranges, "block").sortWithinPartitions("block", "extra", F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    return rows.mapInPandas(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                                 "near_edited double, near_next double")
