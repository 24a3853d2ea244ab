"""Source divergence audit by count-cell ranking.

For every (lang, source) group: how far its term rates are from those of the
other sources of the language, and which terms it uses more than its language
does.  A rate is the integer p = 1 + floor(10^9 * (count + 2) / (N + 2 * V));
the divergence of two rates is f = floor((p - q)^2 / (p + q)).  Both depend on
counts alone, so terms are never ranked one by one.

Terms of a group are counted by cell (group count, lang count); f is evaluated
once a cell; cells of equal value are merged; a value stays while fewer than
``top`` terms stand above it by cumulative multiplicity; only the cells of
these values are expanded into terms, in UTF-8 order.

Divergences between sources are sums over cells too.  The kept terms of a
language are dealt into buckets, its sources into blocks; the rows of a bucket
and two blocks are one task, which counts the cells (rate here, rate there) of
two sources and sends one sum for each pair of them.  A source without a term
is there by its rate of a zero count.  No pair of rows is ever a row; the
result itself is one row a pair of sources.

Edge cases: a null text, lang or source is empty; a group without terms has
the rates of zero counts; a language without kept terms has V = 0, no term
rows and pairs of value 0; rows that repeat an id are documents of their own;
very long texts are counted whole; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from docweave.llm.common import shared_table, small_side, utf8

MIN_DOCS = 10
TOP = 10
#: Terms of a bucket and sources of a block: a task sees one bucket of two blocks.
BUCKET_TERMS, BLOCK_SOURCES = 2048, 256
#: (group, term) counts that a task holds before it sends them on.
HELD = 200_000

#: A-Z lower-cased, a-z and the bytes of non-ASCII signs as they are, all else a blank.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def terms(raw: bytes) -> list[bytes]:
    """Terms of UTF-8 bytes in their order."""
    return raw.translate(_LETTERS).split()


def term_counts(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences and documents of every term in every group."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, tuple[Counter, Counter]] = {}
        size = 0

        def made() -> pd.DataFrame:
            rows = [(*group, t, n, seen[t]) for group, (count, seen) in held.items() for t, n in count.items()]
            held.clear()
            return pd.DataFrame(rows, columns=["lang", "source", "term", "n", "docs"])

        for f in frames:
            for lang, source, text in zip(f["lang"], f["source"], f["text"]):
                own = terms(utf8(text))
                count, seen = held.setdefault((lang, source), (Counter(), Counter()))
                before = len(count)
                count.update(own)
                seen.update(set(own))
                size += len(count) - before
                if size > HELD:
                    yield made()
                    size = 0
        yield made()

    rows = docs.mapInPandas(run, "lang string, source string, term binary, n long, docs long")
    rows = rows.select("lang", "source", F.col("term").cast("string").alias("term"), "n", "docs")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def rate(n: Column, total: Column, v: Column) -> Column:
    """p of a count; decimals, as the product may pass a long."""
    wide = F.lit(1_000_000_000).cast("decimal(10,0)") * (n + 2).cast("decimal(20,0)")
    return 1 + F.call_function("div", wide, (total + 2 * v).cast("decimal(20,0)")).cast("long")


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def kept_terms(docs: DataFrame, min_docs: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Kept terms ``(lang, term, lang_n)``; their counts ``(lang, source, term, n, lang_n)``;
    every group ``(lang, source, total, lang_total, v, sources)``."""
    counts = shared_table(term_counts(docs), "term-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    kept = shared_table(kept.where(F.col("docs") >= min_docs).drop("docs"), "kept-terms")
    rows = shared_table(counts.drop("docs").join(kept, ["lang", "term"]), "kept-counts")
    found = docs.select("lang", "source").distinct()
    own = rows.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = found.groupBy("lang").agg(F.count("*").alias("sources")).join(
        kept.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count("*").alias("v")), "lang", "left")
    groups = found.join(own, ["lang", "source"], "left").join(langs, "lang").na.fill(0, ["total", "lang_total", "v"])
    return kept, rows, shared_table(groups, "term-groups")


def term_ranks(rows: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """``(lang, source, item, value, rank)`` of the ``top`` terms above the language's rate."""
    rates = rate(F.col("n"), F.col("total"), F.col("v")), rate(F.col("lang_n"), F.col("lang_total"), F.col("v"))
    cells = rows.groupBy("lang", "source", "n", "lang_n").agg(F.count("*").alias("terms")).join(groups, ["lang", "source"])
    cells = cells.select("lang", "source", "n", "lang_n", "terms", rates[0].alias("p"), rates[1].alias("q")).where("p > q")
    cells = shared_table(cells.withColumn("value", divergence(F.col("p"), F.col("q"))), "term-cells")
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    merged = cells.groupBy("lang", "source", "value").agg(F.sum("terms").alias("terms"))
    merged = merged.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= top)  # a value has a term at least
    above = F.coalesce(F.sum("terms").over(best.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    stays = merged.withColumn("above", above).where(F.col("above") < top).select("lang", "source", "value")
    chosen = shared_table(cells.join(stays, ["lang", "source", "value"]).select("lang", "source", "n", "lang_n", "value"), "term-top")
    found = rows.join(small_side(chosen, chosen.count()), ["lang", "source", "n", "lang_n"])
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return found.select("lang", "source", F.col("term").alias("item"), "value", "rank")


def _bucket_sums(f: pd.DataFrame) -> pd.DataFrame:
    """Sums of f for every pair of sources of a bucket and two blocks of sources."""
    none = f["term"].isna().to_numpy()
    own = f[none].sort_values("source")
    names, block, zero, size = own["source"].to_numpy(), own["block"].to_numpy(), own["p"].to_numpy(np.int64), int(own["size"].iloc[0])
    cells = f[~none]
    term, known = pd.factorize(cells["term"])
    p = np.tile(zero, (len(known), 1))
    p[term, pd.Index(names).get_indexer(cells["source"])] = cells["p"].to_numpy(np.int64)
    absent = size - len(known)
    a, b = int(f["a"].iloc[0]), int(f["b"].iloc[0])
    level = [np.unique(p[:, i], return_inverse=True) for i in range(len(names))]
    out = []
    for i in range(len(names)):
        for j in range(i + 1, len(names)):
            if {block[i], block[j]} != {a, b}:
                continue
            (x, at), (y, to) = level[i], level[j]
            cell, terms_ = np.unique(at * len(y) + to, return_counts=True)
            x, y = np.append(x[cell // max(1, len(y))], zero[i]), np.append(y[cell % max(1, len(y))], zero[j])
            value = (x - y) ** 2 // np.maximum(x + y, 1)
            out.append((names[i], names[j], int((value * np.append(terms_, absent)).sum())))
    got = pd.DataFrame(out, columns=["source", "item", "value"])
    got.insert(0, "lang", f["lang"].iloc[0])
    return got


def pair_ranks(kept: DataFrame, rows: DataFrame, groups: DataFrame, bucket_terms: int = BUCKET_TERMS, block_sources: int = BLOCK_SOURCES) -> DataFrame:
    """``(lang, source, item, value, rank)``: all other sources of the language by their divergence."""
    def share(n: str, size: int) -> Column:
        return F.greatest(F.lit(1), F.ceil(F.col(n) / size)).cast("long")

    groups = groups.withColumns({"buckets": share("v", bucket_terms), "blocks": share("sources", block_sources)})
    groups = groups.withColumn("block", F.pmod(F.xxhash64("source"), "blocks"))
    langs = groups.select("lang", "buckets").distinct()
    bucket = F.pmod(F.xxhash64("term"), "buckets")
    sizes = kept.join(langs, "lang").groupBy("lang", bucket.alias("bucket")).agg(F.count("*").alias("size"))
    here = F.when(F.col("v") > 0, rate(F.lit(0), F.col("total"), F.greatest("v", F.lit(1)))).otherwise(0)
    zeros = groups.select("lang", "source", "block", "blocks", here.alias("p"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("buckets") - 1)).alias("bucket"))
    zeros = zeros.join(sizes, ["lang", "bucket"], "left").select("lang", "source", "block", "blocks", "bucket", F.lit(None).cast("string").alias("term"), "p",
                                                              F.coalesce("size", F.lit(0)).alias("size"))
    cells = rows.join(groups, ["lang", "source"]).select("lang", "source", "block", "blocks", bucket.alias("bucket"), "term",
                                                         rate(F.col("n"), F.col("total"), F.col("v")).alias("p"), F.lit(0).cast("long").alias("size"))
    others = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda o: F.struct(F.least("block", o).alias("a"), F.greatest("block", o).alias("b")))
    dealt = zeros.unionByName(cells).select("lang", "bucket", F.inline(others), "block", "source", "term", "p", "size")
    sums = dealt.groupBy("lang", "bucket", "a", "b").applyInPandas(_bucket_sums, "lang string, source string, item string, value long")
    sums = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return sums.select("lang", F.inline(both), "value").withColumn("rank", F.row_number().over(order))


def audit(df: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``(lang, source, part, item, value, rank)``: part ``pair`` ranks the other sources of
    a group's language, part ``term`` the terms it uses more than its language."""
    docs = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))])
    kept, rows, groups = kept_terms(docs, min_docs)
    parts = {"pair": pair_ranks(kept, rows, groups), "term": term_ranks(rows, groups, top)}
    pair, term = (part.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank") for name, part in parts.items())
    return pair.unionByName(term)


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
t AS (SELECT rid, lang, source, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT rid) >= 10),
langs AS (SELECT lang, sum(n) AS total, count(*) AS v FROM kept GROUP BY lang),
q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 2)) // (total + 2 * v) AS q FROM kept JOIN langs USING (lang)),
g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
own AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL),
c AS (SELECT g.lang, g.source, k.term, coalesce(own.n, 0) AS n FROM g JOIN kept k ON k.lang = g.lang
      LEFT JOIN own ON own.lang = g.lang AND own.source = g.source AND own.term = k.term),
p AS MATERIALIZED (SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER w + 2 * count(*) OVER w) AS p
      FROM c WINDOW w AS (PARTITION BY lang, source)),
sums AS (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
      FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value FROM g a
      JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
top AS (SELECT p.lang, p.source, p.term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value
      FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pairs
UNION ALL
SELECT lang, source, 'term', item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS r FROM top QUALIFY r <= 10
"""
