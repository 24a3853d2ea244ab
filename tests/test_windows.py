"""Ordinals within groups: sparse and string keys, block sizes."""

import random

import pytest
from pyspark.sql import functions as F

from docweave.operators import windows as W


def _rows(seed, n):
    rng = random.Random(seed)
    values = rng.sample(range(-(1 << 60), 1 << 60), n)
    return [("hot" if rng.random() < 0.7 else f"g{rng.randint(0, 5)}", v, rng.randint(0, 9)) for v in values]


def _positions(rows):
    seen = {}
    for g, v, x in sorted(rows, key=lambda r: (r[0], r[1])):
        n, total = seen.get(g, (0, 0))
        yield g, v, n + 1, total
        seen[g] = (n + 1, total + x)


@pytest.mark.parametrize("dense", [True, False])
def test_sparse_integers_and_running_sums(spark, dense):
    rows = _rows(1, 3000)
    df = spark.createDataFrame(rows, "g string, v long, x long")
    got = W.ordinal_within(df, ["g"], "v", "n", sums={"before": "x"}, dense=dense)
    assert got.columns == ["g", "v", "x", "n", "before"]
    assert sorted((r.g, r.v, r.n, r.before) for r in got.collect()) == sorted(_positions(rows))


def test_counts_of_sparse_blocks_are_summed_by_span(spark):
    rows = _rows(2, 5000)
    df = spark.createDataFrame(rows, "g string, v long, x long")
    blk = F.shiftright("v", W.DEFAULT_BLOCK_BITS)
    spans = df.where("g = 'hot'").groupBy(F.shiftright(blk, W.SPAN_BITS)).count()
    assert spans.agg(F.max("count")).first()[0] < 20


@pytest.mark.parametrize("kind", ["long", "string"])
def test_large_groups_split_at_sampled_quantiles(spark, kind):
    rows = _rows(3, 6000)
    make = (lambda v: v) if kind == "long" else (lambda v: f"https://host.test/{v:020d}")
    df = spark.createDataFrame([(g, make(v), x) for g, v, x in rows], f"g string, v {kind}, x long")
    got = W.ordinal_by_range(df, ["g"], "v", "n", block_rows=100)
    assert got.columns == ["g", "v", "x", "n"]
    assert sorted((r.g, r.v, r.n) for r in got.collect()) == sorted(
        (g, v, n) for g, v, n, _ in _positions([(g, make(v), x) for g, v, x in rows]))
    blocks = W.range_blocks(df, ["g"], "v", block_rows=100).groupBy("g", "__blk").count()
    sizes = [r["count"] for r in blocks.where("g = 'hot'").collect()]
    assert len(sizes) > 30 and max(sizes) < 300


def test_ranges_with_ties_nulls_and_no_rows(spark):
    df = spark.createDataFrame([("g", v) for v in [None, None, *"aabbbbcd" * 20]], "g string, v string")
    rows = W.ordinal_by_range(df, ["g"], "v", "n", block_rows=10).orderBy("n").collect()
    assert [r.n for r in rows] == list(range(1, 163))
    assert [r.v for r in rows] == [None, None, *sorted("aabbbbcd" * 20)]
    assert W.ordinal_by_range(df.limit(0), ["g"], "v", "n").count() == 0
