"""Skew-safe ordinals within groups.

``row_number().over(partitionBy(g).orderBy(o))`` puts a whole group into one
task; when one group holds a third of the data that task is the job.  The
blocked forms below split each group into blocks of the order key, count rows
per block (a partial/final hash aggregate), prefix-sum the small block table
and number rows inside each block only.

* :func:`ordinal_within` cuts an integral key by its bits.  Where values are
  sparse nearly every row is a block of its own, so blocks are summed in spans
  of 2**24 blocks and spans within the group: no window holds more than that.
* :func:`ordinal_by_range` takes any orderable key, such as a string: a large
  group is cut at quantiles of a hash sample of its values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BLOCK_BITS = 16
#: Blocks whose counts are summed by one task, as a power of two.
SPAN_BITS = 24
#: Rows of a block that :func:`ordinal_by_range` aims at.
RANGE_ROWS = 65536
#: Most ranges of a group, and sampled values for each of them.
MAX_RANGES = 4096
RANGE_SAMPLE = 16


def _before(col: str, window) -> Column:
    return F.coalesce(F.sum(col).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _number(
    with_blk: DataFrame, keys: list[str], order_col: str, out_col: str, sums: dict[str, str], span: Column | None
) -> DataFrame:
    """Number rows by their block ``__blk``; with ``span`` the blocks of a group are summed in two steps."""
    carried = ["__n", *[f"__sum_{out}" for out in sums]]
    totals = [F.sum(c).alias(f"__sum_{out}") for out, c in sums.items()]
    counts = with_blk.groupBy(*keys, "__blk").agg(F.count(F.lit(1)).alias("__n"), *totals)
    if span is None:
        w = Window.partitionBy(*keys).orderBy("__blk")
        offsets = counts.select(*keys, "__blk", *[_before(c, w).alias(f"__off{c}") for c in carried])
    else:
        counts = counts.withColumn("__span", span)
        spans = counts.groupBy(*keys, "__span").agg(*[F.sum(c).alias(c) for c in carried])
        w = Window.partitionBy(*keys).orderBy("__span")
        spans = spans.select(*keys, "__span", *[_before(c, w).alias(f"__base{c}") for c in carried])
        w = Window.partitionBy(*keys, "__span").orderBy("__blk")
        offsets = counts.select(*keys, "__span", "__blk", *[_before(c, w).alias(f"__in{c}") for c in carried])
        offsets = offsets.join(spans, [*keys, "__span"]).select(
            *keys, "__blk", *[(F.col(f"__base{c}") + F.col(f"__in{c}")).alias(f"__off{c}") for c in carried])
    w_rows = Window.partitionBy(*keys, "__blk").orderBy(order_col)
    running = {out: (F.col(f"__off__sum_{out}") + _before(c, w_rows)).cast("bigint") for out, c in sums.items()}
    return (
        with_blk.join(offsets, [*keys, "__blk"])
        .withColumns({out_col: (F.col("__off__n") + F.row_number().over(w_rows)).cast("bigint"), **running})
        .drop("__blk", *[f"__off{c}" for c in carried])
    )


def ordinal_within(
    df: DataFrame,
    keys: list[str],
    order_col: str,
    out_col: str = "rn",
    block_bits: int = DEFAULT_BLOCK_BITS,
    sums: dict[str, str] | None = None,
    dense: bool = False,
) -> DataFrame:
    """Add ``out_col`` = 1-based position of each row in its ``keys`` group by
    the (unique within group, integral) ``order_col``.  ``sums`` maps a column
    to be added to the one whose total over the rows before it is.  ``dense``:
    the values of a group have few gaps, so its blocks are few."""
    with_blk = df.withColumn("__blk", F.shiftright(F.col(order_col).cast("bigint"), block_bits))
    span = None if dense else F.shiftright("__blk", SPAN_BITS)
    return _number(with_blk, keys, order_col, out_col, sums or {}, span)


def range_blocks(df: DataFrame, keys: list[str], order_col: str, block_rows: int = RANGE_ROWS) -> DataFrame:
    """Add ``__blk``: the range of ``order_col`` a row falls in, 0 in groups of
    at most ``block_rows`` rows.

    The sample of a large group is made of the values whose hash is small, so
    it is the same each time it is taken, merges from any partitions and holds
    about ``RANGE_SAMPLE`` values a range, however large the group is.  Its
    quantiles are the bounds; a row finds its range by halving."""
    blocks = F.least(F.ceil(F.col("__rows") / block_rows), F.lit(MAX_RANGES)).cast("int")
    large = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > block_rows)
    large = large.select(*keys, blocks.alias("__blocks"), (F.lit(float(RANGE_SAMPLE)) * blocks / F.col("__rows")).alias("__rate"))
    draw = F.xxhash64(order_col).bitwiseAND(F.lit((1 << 31) - 1)) / F.lit(float(1 << 31))
    taken = df.select(*keys, order_col).join(large, keys).where(draw < F.col("__rate"))
    taken = taken.groupBy(*keys, "__blocks").agg(F.array_sort(F.collect_set(order_col)).alias("__v"))
    at = F.transform(F.sequence(F.lit(1), F.col("__blocks") - 1),
                     lambda i: F.get("__v", F.floor(i * F.size("__v") / F.col("__blocks")).cast("int")))
    bounds = taken.select(*keys, F.array_distinct(at).alias("__bounds"))
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(MAX_RANGES.bit_length()))])

    def halve(at_or_below: Column, step: Column) -> Column:
        there = F.get("__bounds", at_or_below + step - 1)  # null beyond the last bound
        return F.when(there <= F.col(order_col), at_or_below + step).otherwise(at_or_below)

    blk = F.when(F.col("__bounds").isNull(), F.lit(0)).otherwise(F.aggregate(steps, F.lit(0), halve))
    return df.join(bounds, keys, "left").withColumn("__blk", blk).drop("__bounds")


def ordinal_by_range(
    df: DataFrame, keys: list[str], order_col: str, out_col: str = "rn", block_rows: int = RANGE_ROWS
) -> DataFrame:
    """:func:`ordinal_within` for any orderable ``order_col``.  Rows that tie
    stand side by side in any order; nulls come first."""
    return _number(range_blocks(df, keys, order_col, block_rows), keys, order_col, out_col, {}, None)


def first_by_order(df: DataFrame, key: Column | str, order_col: str) -> DataFrame:
    """Keep the row with the smallest ``order_col`` per ``key`` (first wins).

    Aggregates ``min(order)`` per key (map-side partial aggregation, so a hot key
    costs one row per map task) and semi-joins back on the order value, which
    is unique per row.
    """
    k = F.col(key) if isinstance(key, str) else key
    firsts = df.groupBy(k.alias("__key")).agg(F.min(order_col).alias("__first"))
    return df.join(firsts.select(F.col("__first").alias(order_col)), order_col, "left_semi")
