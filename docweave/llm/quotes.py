"""Chat formatting: link quotations to the messages they quote.

A message's lines are parsed into quote levels (``>`` signs, nested with or
without blanks).  Consecutive lines of one level are a passage.  Passages are
normalised (A-Z lower-cased, runs of white space one blank) and hashed: the
quoted ones whole and line by line, the unquoted ones of every message
likewise.  A quoted passage joins the first message of its conversation that
says it; a reply's parent is the latest message before it that one of its
outermost passages quotes (deeper passages are linked too, but name older
messages).  Threads follow from parents by pointer doubling; within a
conversation they stand in the order of their first messages, replies in
message order below them, every reply after its parent.  The text that is
left has no quotes and no attribution lines before them.

Edge cases: a null text is empty; quotes of unknown passages stay unlinked
and are cut all the same; a null conversation is one conversation of its own,
a null turn stands first and is never quoted; rows that repeat a turn are
each kept; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from docweave.llm.common import shared_table, utf8

QUOTE = re.compile(r"\s{0,3}((?:>\s?)+)(.*)", re.S)
SAID = re.compile(r".{1,200}(?:wrote|writes|said|schrieb|a écrit|escribió)\s*:\s*$")


def parsed(text: str) -> tuple[str, list[tuple[int, list[str]]]]:
    """The text without quotes, and its quoted passages ``(level, lines)``."""
    own: list[str] = []
    passages: list[tuple[int, list[str]]] = []
    level = 0
    for line in text.split("\n"):
        m = QUOTE.fullmatch(line)
        depth = m[1].count(">") if m else 0
        if depth:
            if not level:
                while own and not own[-1].strip():
                    own.pop()
                if own and SAID.fullmatch(own[-1]):
                    own.pop()
            if depth != level or not passages:
                passages.append((depth, []))
            passages[-1][1].append(m[2])
        else:
            own.append(line)
        level = depth
    return "\n".join(own).strip("\n"), passages


def passage_hash(lines: list[str]) -> int | None:
    words = utf8("\n".join(lines)).lower().split()
    return xxhash.xxh64_intdigest(b" ".join(words)) - (1 << 63) if words else None


def said_hashes(own: str) -> list[int]:
    """Hashes under which a message can be quoted: its text, its paragraphs and its lines."""
    lines = own.split("\n")
    units, run = [lines], []
    for line in [*lines, ""]:
        if line.strip():
            run.append(line)
            units.append([line])
        elif run:
            units.append(run)
            run = []
    return sorted({h for h in map(passage_hash, units) if h is not None})


def parse_messages(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``(conv_id, turn, role, text, said, quoted array<struct<level, hash, hashes>>)``."""
    rows = df.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                     F.col(role_col).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"))

    @F.pandas_udf("struct<text: string, said: array<long>, quoted: array<struct<level: int, hash: long, hashes: array<long>>>>")
    def run(texts: pd.Series) -> pd.DataFrame:
        out = []
        for t in texts:
            own, passages = parsed(t)
            quoted = [{"level": level, "hash": passage_hash(lines), "hashes": said_hashes("\n".join(lines))} for level, lines in passages]
            out.append((own, said_hashes(own), [q for q in quoted if q["hash"] is not None]))
        return pd.DataFrame(out, columns=["text", "said", "quoted"])

    return rows.withColumn("m", run("text")).select("conv_id", "turn", "role", "m.text", "m.said", "m.quoted")


def quotation_links(messages: DataFrame) -> DataFrame:
    """``(conv_id, turn, passage, level, original_turn)``: each quoted passage
    with the first message of the conversation that says it, whole or else the
    first that says one of its lines; earlier turns only."""
    # one row for each thing said: a passage that is said everywhere does not multiply
    first = messages.select("conv_id", "turn", F.explode("said").alias("h")).where("turn IS NOT NULL").groupBy("conv_id", "h").agg(
        F.min("turn").alias("original_turn"))
    first = shared_table(first.withColumnRenamed("conv_id", "_c"), "said")
    quoted = messages.select("conv_id", "turn", F.posexplode("quoted").alias("passage", "q"))
    keys = quoted.select("conv_id", "turn", "passage", "q.level", F.explode(F.array_distinct(F.concat(
        F.array(F.struct(F.lit(0).alias("part"), F.col("q.hash").alias("h"))),
        F.transform("q.hashes", lambda h: F.struct(F.lit(1).alias("part"), h.alias("h")))))).alias("k"))
    keys = keys.select("conv_id", "turn", "passage", "level", "k.part", "k.h")
    found = keys.join(first, [keys.h == first.h, keys.conv_id.eqNullSafe(first["_c"])]).where("original_turn < turn")
    best = found.groupBy("conv_id", "turn", "passage", "level").agg(F.min(F.struct("part", "original_turn")).alias("b"))
    return best.select("conv_id", "turn", "passage", "level", F.col("b.original_turn").alias("original_turn"))


def _threads(parents: DataFrame) -> DataFrame:
    """``(conv_id, turn, thread, depth)`` from ``(conv_id, turn, parent)`` by pointer doubling."""
    rows = parents.select("conv_id", "turn", F.col("parent").alias("up"), F.lit(1).alias("depth"))
    while True:
        rows = shared_table(rows, "threads")
        above = rows.select(F.col("conv_id").alias("_c"), F.col("turn").alias("_t"), F.col("up").alias("_up"), F.col("depth").alias("_d"))
        joined = rows.join(above, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("up") == F.col("_t")), "left")
        if joined.where("_t IS NOT NULL").isEmpty():
            return rows.select("conv_id", "turn", F.col("up").alias("thread"), "depth")
        rows = joined.select("conv_id", "turn", F.coalesce("_up", "up").alias("up"), (F.col("depth") + F.coalesce("_d", F.lit(0))).alias("depth"))


def reply_order(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Every message as ``(conv_id, thread_turn, turn, parent_turn, depth,
    n_quotes, n_linked, role, text, formatted)``: sorted by ``conv_id,
    thread_turn, turn`` a conversation is in reply order."""
    messages = shared_table(parse_messages(df, conv_col, turn_col, role_col, text_col), "messages")
    links = shared_table(quotation_links(messages), "quotations")
    replies = links.groupBy("conv_id", "turn").agg(
        F.max(F.when(F.col("level") == 1, F.col("original_turn"))).alias("outer"), F.max("original_turn").alias("any"), F.count("*").alias("n_linked"))
    replies = shared_table(replies.select("conv_id", "turn", F.coalesce("outer", "any").alias("parent"), "n_linked"), "replies")
    threads = _threads(replies).join(replies.select(F.col("conv_id").alias("_c"), F.col("turn").alias("_t"), "parent", "n_linked"),
                                     F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("turn") == F.col("_t")))
    threads = shared_table(threads.select(F.col("_c"), F.col("_t"), "thread", "depth", "parent", "n_linked"), "reply-threads")
    out = messages.join(threads, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("turn") == F.col("_t")), "left")
    return out.select("conv_id", F.coalesce("thread", "turn").alias("thread_turn"), "turn", F.col("parent").alias("parent_turn"),
                      F.coalesce("depth", F.lit(0)).alias("depth"), F.size("quoted").alias("n_quotes"),
                      F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), "role", "text",
                      F.concat(F.lit("<|"), F.coalesce("role", F.lit("user")), F.lit("|>\n"), F.col("text"), F.lit("\n")).alias("formatted"))
