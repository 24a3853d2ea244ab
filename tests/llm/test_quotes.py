"""Quotation linking."""

from docweave.llm import quotes as Q

SCHEMA = "conv_id long, turn long, role string, text string, thread_turn string, parent long"


def rows(spark, *messages):
    return spark.createDataFrame([(c, t, r, x, "z", 9) for c, t, r, x in messages], SCHEMA)


def test_parse_levels():
    own, passages = Q.parsed("Hello\nOn Monday Ann wrote:\n> a b\n> c\n>> deep\n> > deeper too\n> d\n\nMy answer\n> tail")
    assert own == "Hello\n\nMy answer"
    assert passages == [(1, ["a b", "c"]), (2, ["deep", "deeper too"]), (1, ["d"]), (1, ["tail"])]


def test_reply_order(spark):
    df = rows(spark,
              (1, 0, "user", "First question?\n\nSecond   Question here."),
              (1, 1, "user", "An unrelated start"),
              (1, 2, "assistant", "> second question HERE.\nanswer to the second"),
              (1, 3, "user", "> answer to the second\n>> Second question here.\nthanks"),
              (1, 4, "assistant", "> an unrelated start\nreply"),
              (1, 5, "user", "> nobody said this\nlost"),
              (2, 0, "user", "> First question?\nother conversation"),
              (1, 6, "user", "> first question?\n> not said\npartly"),
              (None, 0, None, None), (None, 1, "user", "x"), (None, 2, "user", "> x\ny"), (3, None, "user", "> q"))
    got = {(r.conv_id, r.turn): r for r in Q.reply_order(df).collect()}
    assert len(got) == 12
    assert {t: (got[1, t].thread_turn, got[1, t].parent_turn, got[1, t].depth) for t in range(7)} == {
        0: (0, None, 0), 1: (1, None, 0), 2: (0, 0, 1), 3: (0, 2, 2), 4: (1, 1, 1), 5: (5, None, 0), 6: (0, 0, 1)}
    assert got[1, 3].text == "thanks" and got[1, 3].n_quotes == 2 and got[1, 3].n_linked == 2
    assert got[2, 0].parent_turn is None and got[2, 0].text == "other conversation"
    assert got[None, 2].parent_turn == 1 and got[None, 0].text == ""


def test_long_chain_and_repeated_rows(spark):
    chain = [(1, 0, "user", "m0")] + [(1, i, "user", f"> m{i - 1}\nm{i}") for i in range(1, 12)]
    got = Q.reply_order(rows(spark, *chain, chain[3], chain[3])).collect()
    assert len(got) == 14 and {r.thread_turn for r in got} == {0}
    assert all(r.depth == r.turn for r in got)


def test_empty_table(spark):
    assert Q.reply_order(rows(spark)).count() == 0
