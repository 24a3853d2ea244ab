"""Containment search against brute force."""

import random
import re

from docweave.llm import decontaminate as D
from llm_fixtures import docs  # noqa: F401


def grams(text, n=5):
    words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


def brute(docs, items):
    out = []
    for i, d in docs:
        for j, b in items:
            own = grams(b)
            shared = len(own & grams(d))
            if own and shared >= 0.8 * len(own) - 1e-9:
                out.append((i, j, shared, len(own)))
    return sorted(out)


def test_equals_brute_force(spark, docs):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(3))
    items = [(i, " ".join(word() for _ in range(rng.choice([2, 4, 5, 6, 9, 17, 40, 70])))) for i in range(30)]
    items += [(30, None), (31, ""), (3, items[3][1])]
    rows = [(0, None), (1, ""), (2, "short one")]
    for k in range(3, 60):
        text = " ".join(word() for _ in range(rng.randint(1, 200)))
        own = rng.choice(items)[1] or ""
        if rng.random() < 0.3 and own:
            words = own.split()
            words[rng.randrange(len(words))] = "changed"
            own = " ".join(words)
        rows.append((k, text + " " + own.upper() + ". " + text[:50]))
    rows.append((5, rows[5][1]))
    got = D.contamination(docs(rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    expect = sorted(set(brute(rows, items)))
    assert sorted({(r.doc_id, r.item_id, r.n_shared, r.n_item) for r in got}) == expect and expect
    assert all(r.containment == r.n_shared / r.n_item for r in got)


def test_native_plan(docs, spark):
    df = D.contamination(docs([(1, "a b c d e f g")]), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string"))
    plan = df._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert [(r.doc_id, r.item_id) for r in df.collect()] == [(1, 1)]


def test_rows_and_empty_tables(docs, spark):
    items = spark.createDataFrame([(1, "one two three four five six seven")], "item_id long, text string")
    df = docs([(1, "zero one two three four five six seven eight"), (2, "clean text of some words here"), (None, "no id"), (3, None)])
    out = D.decontaminate(df, items)
    assert out.columns == df.columns
    assert sorted((r.doc_id or -1) for r in out.collect()) == [-1, 2, 3]
    assert D.contamination(docs([]), items).count() == 0
    assert D.contamination(df, items.limit(0)).count() == 0


def test_clean_texts_under_the_id_of_a_contaminated_one_stay(docs, spark):
    items = spark.createDataFrame([(1, "one two three four five six seven")], "item_id long, text string")
    bad = "zero one two three four five six seven eight"
    out = D.decontaminate(docs([(None, bad), (None, "clean text"), (4, bad), (4, "another clean text"), (None, None)]), items)
    assert sorted((str(r.doc_id), str(r.text)) for r in out.collect()) == [("4", "another clean text"), ("None", "None"), ("None", "clean text")]
