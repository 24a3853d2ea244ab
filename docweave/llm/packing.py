"""Packing by power-of-two decomposition: no sequence crosses documents.

A document is its token ids and one closing id 0.  Its length n is written in
binary: as many pieces of ``capacity`` ids as fit, then one piece for each set
bit of what is left, largest first, so the pieces follow each other without a
gap.  Every piece is a sequence of its own.  Its length is a power of two, so
it needs no padding, and sequences of one length are one bucket, from which a
trainer draws batches of equal shape.

Sequences are numbered without gaps, longest bucket first, within a bucket in
the order of the tasks that cut them.  A task counts its own pieces by length
and writes them with its number; the numbers before a task's pieces are prefix
sums over (length, task), so no bucket is ever in one task, and a piece table
that is written keeps its numbers when executors are lost.

Token ids are those of the tokenizer file.  Where its rules allow it (byte-level
BPE, merges in the order of their ids), tiktoken computes the same ids several
times faster; a text that holds an added token of the file, or that tiktoken
gives up on (very long runs of white space), goes to the tokenizer itself.

Edge cases: a null or empty text is the closing id alone, one piece of length
1; very long texts are cut like all others; rows that repeat an id are packed
each on its own; a null id stays null; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from docweave.llm.common import shared_table, small_side, texts

CAPACITY = 1024
CLOSING_ID = 0
#: Token bytes and pieces that a task holds before it sends them on.
HELD_BYTES, HELD_PIECES = 16 << 20, 20_000


def _byte_signs() -> dict[str, int]:
    """The byte-level alphabet: printable bytes are themselves, the others the signs from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _ranks(spec: dict) -> dict[bytes, int] | None:
    """Bytes of every vocabulary entry by id, or None where ids don't tell the order of merges."""
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (model.get("type", "BPE") == "BPE" and not spec.get("normalizer") and split.get("type") == "ByteLevel"
             and not split.get("add_prefix_space") and split.get("use_regex", True)
             and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")))
    if not plain:
        return None
    vocab, signs = model["vocab"], _byte_signs()
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [vocab[a + b] for a, b in pairs]
    if any(x >= y for x, y in zip(made, made[1:])) or any(set(v) - signs.keys() for v in vocab):
        return None
    return {bytes(signs[c] for c in v): i for v, i in vocab.items()}


def encoder(path: str) -> Callable[[str], list[int]]:
    """Text to ids of a tokenizer file, without special tokens added."""
    import tiktoken
    from tiktoken import registry
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    ranks = _ranks(spec)
    added = [t["content"] for t in spec.get("added_tokens") or []]

    def by_file(text: str) -> list[int]:
        return whole.encode(text, add_special_tokens=False).ids

    if ranks is None:
        return by_file
    # the split of byte-level BPE; a fixed pattern
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    fast = registry.ENCODINGS.get(path) or tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    registry.ENCODINGS[path] = fast

    def ids(text: str) -> list[int]:
        if any(a in text for a in added):
            return by_file(text)
        try:
            return fast.encode_ordinary(text)
        except BaseException as e:  # a Rust panic is no Exception
            if type(e).__name__ != "PanicException":
                raise
            return by_file(text)

    return ids


def binary_lengths(n: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of the pieces of ``n`` ids: whole capacities, then the set bits of the rest."""
    rest = n % capacity
    return [capacity] * (n // capacity) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


PIECES = "doc_id long, start long, length long, tokens binary, doc_tokens long, task int, nth long"


def cut(docs: DataFrame, tokenizer: str, capacity: int) -> DataFrame:
    """Pieces of ``(doc_id, text)`` with their task and their number among the task's pieces of that length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, task = encoder(tokenizer), TaskContext.get().partitionId()
        types = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("tokens", pa.binary()),
                           ("doc_tokens", pa.int64()), ("task", pa.int32()), ("nth", pa.int64())])
        count: dict[int, int] = {}
        rows: list[tuple] = []
        size = 0

        def made() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types.types)], schema=types)
            rows.clear()
            return out

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):  # scalars: one text at a time becomes a Python string
                raw = np.array([*ids(text.as_py()), CLOSING_ID], "<u4").tobytes()
                n, start = len(raw) // 4, 0
                for length in binary_lengths(n, capacity):
                    nth = count.get(length, 0)
                    rows.append((doc.as_py(), start, length, raw[4 * start:4 * (start + length)], n, task, nth))
                    count[length] = nth + 1
                    start += length
                    size += 4 * length
                    if size >= HELD_BYTES or len(rows) >= HELD_PIECES:
                        yield made()
                        size = 0
        if rows:
            yield made()

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


def pack(df: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, start, length, tokens, doc_tokens, sequence_id, offset)`` of every piece;
    ``tokens`` are unsigned little-endian 32-bit ids, ``capacity`` is a power of two."""
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    pieces = shared_table(cut(texts(df, id_col, text_col), tokenizer, capacity), "pieces", "zstd")
    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = shared_table(counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"), "n"), "piece-counts")
    n_tasks = tasks.count()
    buckets = tasks.groupBy("length").agg(F.sum("n").alias("n")).orderBy(F.desc("length")).collect()  # one row a power of two
    first, total = {}, 0
    for b in buckets:
        first[b["length"]] = total
        total += b["n"]
    base = F.coalesce(*[F.when(F.col("length") == n, F.lit(at)) for n, at in first.items()], F.lit(0))
    rows = pieces.join(small_side(tasks.drop("n"), n_tasks), ["length", "task"])
    return rows.select("doc_id", "start", "length", "tokens", "doc_tokens",
                       (base + F.col("earlier") + F.col("nth")).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
