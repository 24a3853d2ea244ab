"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from weakref import WeakKeyDictionary

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from docweave.session import ensure_checkpoint_dir

#: Broadcast bound: a side is broadcast only if it was counted and has at most so many rows.
BROADCAST_ROWS = 200_000


#: Spark's own setting to drop the shuffle files of a query at its end.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Paths of the tables of each open ``passing_tables``, outermost first; path of a table.
_BLOCKS: ContextVar[tuple[list[str], ...]] = ContextVar("blocks", default=())
_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def _delete(spark: SparkSession, path: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[None]:
    """Tables that are written inside (``shared_table``) are deleted at the end."""
    own: list[str] = []
    token = _BLOCKS.set((*_BLOCKS.get(), own))
    try:
        yield
    finally:
        _BLOCKS.reset(token)
        for path in own:
            _delete(spark, path)


def drop_table(table: DataFrame) -> None:
    """Delete a ``shared_table`` that nothing reads any more."""
    _delete(table.sparkSession, _PATHS.pop(table))


def shared_table(df: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet below the cluster's shared checkpoint folder and
    read it back: cuts the lineage and survives lost executors.  The shuffles of
    the write end with it, as nothing reads them again."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/docweave-{label}-{uuid.uuid4().hex}"
    for block in _BLOCKS.get()[-1:]:
        block.append(path)
    schema = df.schema
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path, compression=codec)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    table = spark.read.schema(schema).parquet(path)
    _PATHS[table] = path
    return table


def staying_table(df: DataFrame, label: str) -> DataFrame:
    """A ``shared_table`` that outlives the block it is written in (``passing_tables``)
    and belongs to the block around that one, if there is any."""
    table = shared_table(df, label)
    *outer, own = _BLOCKS.get()
    own.remove(_PATHS[table])
    if outer:
        outer[-1].append(_PATHS[table])
    return table


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id long, text string)`` of any table; a null text is empty."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def with_uid(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``texts`` with ``uid``: the id, or a negative number made from the text where the id is null."""
    made = -1 - F.xxhash64("text").bitwiseAND(F.lit((1 << 62) - 1))
    return texts(df, id_col, text_col).withColumn("uid", F.coalesce("doc_id", made))


def union_all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast if the counted size is within the bound; a shuffle join otherwise."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def utf8(text) -> bytes:
    """UTF-8 bytes of a text cell (null or NaN: empty)."""
    return text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""


_PLAIN = bytes(b if chr(b).isalnum() or b > 127 else 32 for b in range(256))


def plain_words(raw: bytes) -> list[bytes]:
    """Words of UTF-8 bytes: A-Z lower-cased, runs of ASCII letters, digits and non-ASCII signs."""
    return raw.lower().translate(_PLAIN).split()


def sorted_runs(frames: Iterable[pd.DataFrame], keys: list[str], least: int = 50_000) -> Iterator[pd.DataFrame]:
    """Re-cut the sorted rows of a partition so that no key is split: chunks of
    at least ``least`` rows (the last may be smaller), whole keys only."""
    held: list[pd.DataFrame] = []
    n = 0
    for f in frames:
        if not len(f):
            continue
        held.append(f)
        n += len(f)
        if n < least:
            continue
        all_rows = pd.concat(held, ignore_index=True)
        last = all_rows[keys].iloc[-1]
        same = np.ones(len(all_rows), bool)
        for k in keys:
            same &= (all_rows[k] == last[k]).to_numpy()
        cut = len(all_rows) - int(same[::-1].argmin() if not same.all() else len(all_rows))
        if cut:
            yield all_rows.iloc[:cut]
        held, n = ([all_rows.iloc[cut:]], len(all_rows) - cut)
    if held:
        yield pd.concat(held, ignore_index=True)


def run_starts(*columns: np.ndarray) -> np.ndarray:
    """Start indexes of runs of equal values in sorted columns."""
    n = len(columns[0])
    if not n:
        return np.zeros(0, np.int64)
    new = np.zeros(n, bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)
