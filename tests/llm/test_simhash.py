"""SimHash near-dedup against brute force."""

import os
import random

import numpy as np
import pandas as pd
import xxhash

from docweave.llm import simhash as S
from docweave.session import ensure_checkpoint_dir
from llm_fixtures import docs  # noqa: F401


def brute_fingerprint(text, n=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, bits):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprint_matches_definition():
    for t in ["", "a", "a b", "a b c", "a b c d", "É é X\tx\n y  z", "w " * 50]:
        assert S.text_fingerprint(t.encode(), 3) == brute_fingerprint(t)


def test_links_equal_brute_force_also_in_cut_patterns(spark):
    r = np.random.RandomState(1)
    fps = set(r.randint(0, 2**62, 60).tolist())
    for base in list(fps)[:6]:  # dense groups
        for _ in range(50):
            x = base
            for _ in range(r.randint(1, 6)):
                x ^= 1 << int(r.randint(0, 63))
            fps.add(x)
    fps = sorted(fps)
    expect = brute_components(fps, 2)
    for bucket_rows in (4096, 40):
        df = spark.createDataFrame(pd.DataFrame({"fp": fps}))
        comp = S.components(S.fingerprint_links(df, 2, bucket_rows)).toPandas()
        got = dict(zip(comp.node, comp.component))
        assert [got.get(f, f) for f in fps] == [fps[i] for i in expect]


def test_near_duplicates_edge_cases(docs):
    rng = random.Random(2)
    base = [" ".join(rng.choice("abcdefgh") * 3 + str(rng.randint(0, 99)) for _ in range(60)) for _ in range(12)]
    texts = [None, "", "one", "one two", *base, base[0], base[0].upper(), base[1] + " tail", "x " * 3000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(4, base[0]), (None, base[2]), (None, "only here without an id")]
    got = S.near_duplicates(docs(rows), max_bits=2).toPandas()
    assert len(got) == len(rows)
    fps = [brute_fingerprint(t) for _, t in rows]
    comp = brute_components(fps, 2)
    ids = {}
    for (i, _), c in zip(rows, comp):
        if i is not None:
            ids[c] = min(ids.get(c, i), i)
    expect = sorted((-1 if i is None else i, f, ids.get(c, -1)) for (i, _), f, c in zip(rows, fps, comp))
    assert expect == sorted((int(a), int(b) % 2**64, int(c)) for a, b, c in got[["doc_id", "fp", "component_id"]].fillna(-1).to_numpy(object))


def test_one_of_each_keeps_columns_and_one_row(docs):
    long = " ".join(f"word{i}" for i in range(80))
    df = docs([(1, long), (2, long), (2, long), (3, "other words stand here alone"), (None, "no id at all in this one"), (None, "no id at all in this one")])
    out = S.one_of_each(df)
    assert out.columns == df.columns
    got = [(r.doc_id, r.text) for r in out.collect()]
    assert sorted(got, key=str) == sorted([(1, long), (3, "other words stand here alone"), (None, "no id at all in this one")], key=str)


def test_empty_table(docs):
    assert S.near_duplicates(docs([])).count() == 0
    assert S.one_of_each(docs([])).count() == 0


def test_one_of_each_keeps_different_texts_of_one_id(docs):
    one, two = " ".join(f"word{i}" for i in range(80)), " ".join(f"other{i}" for i in range(80))
    got = S.one_of_each(docs([(5, one), (5, two), (5, two), (6, one)])).collect()
    assert sorted((r.doc_id, r.text) for r in got) == sorted([(5, two), (5, one)])


def test_one_of_each_moves_rows_once_and_leaves_one_table(docs):
    df = docs([(1, "some words stand here alone"), (1, "some words stand here alone"), (None, "no id at all in this one")])
    spark = df.sparkSession
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    out = S.one_of_each(df)
    assert [name.rsplit("-", 1)[0] for name in set(os.listdir(folder)) - before] == ["docweave-kept"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert out.count() == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2  # the rows and the kept keys
