"""Divergence audit against brute force."""

import random
import re
from collections import Counter, defaultdict

import pytest

from docweave.llm import divergence as D

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
DOC = "doc_id long, text string, lang string, source string, term string, n long, rank int, v string"


def brute(rows, min_docs, top):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    count, seen, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = TERM.findall((text or "").translate(lower))
        groups[lang].add(source)
        count[lang, source].update(words)
        seen[lang].update(set(words))
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in seen[lang].items() if n >= min_docs]
        v = len(kept)

        def rates(n):
            total = sum(n[t] for t in kept)
            return {t: 1 + 10**9 * (n[t] + 2) // (total + 2 * v) for t in kept}

        own = {s: rates(count[lang, s]) for s in sources}
        whole = rates(sum((count[lang, s] for s in sources), Counter()))
        f = lambda a, b: (a - b) * (a - b) // (a + b)
        for s in sources:
            pairs = [(-sum(f(own[s][t], own[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            up = [(-f(own[s][t], whole[t]), t.encode()) for t in kept if count[lang, s][t] and own[s][t] > whole[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(up)[:top])):
                out |= {(lang, s, part, item.decode(), -value, i + 1) for i, (value, item) in enumerate(found)}
    return out


def corpus():
    rng = random.Random(11)
    words = [f"w{c}" for c in "abcdefghijklmnopqrst"] + ["Ähre", "ähre", "日本", "ß", "Zoo", "zoo", "ZOO", "x_y", "a\x00b"]
    rows = []
    for i in range(160):
        lang, source = rng.choice(["en", "de", None, ""]), rng.choice([None, "", *[f"s{k}" for k in range(9)], "é", "日"])
        rows.append((" ".join(rng.choices(words, k=rng.randint(0, 30))), lang, source))
    rows += [(None, "en", "s1"), ("", "en", "only empty"), (None, "none", "a"), ("lone words here", "none", "b"), ("lone", "single", None)]
    rows += [("tie one two three four five six seven eight nine ten eleven", "en", "ties")] * 12  # many terms of one cell, repeated rows
    rows += [("hot " * 40_000 + "wa wb", "de", "s3")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i % 7, t, la, s, "x", 1, 2, "v") for i, (t, la, s) in enumerate(rows)], DOC).repartition(3)


@pytest.mark.parametrize("bucket_terms, block_sources, held", [(D.BUCKET_TERMS, D.BLOCK_SOURCES, D.HELD), (4, 3, 10)])
def test_equals_brute_force(spark, monkeypatch, bucket_terms, block_sources, held):
    monkeypatch.setattr(D, "HELD", held)
    pairs = D.pair_ranks
    monkeypatch.setattr(D, "pair_ranks", lambda *a: pairs(*a, bucket_terms=bucket_terms, block_sources=block_sources))
    rows = corpus()
    got = [tuple(r) for r in D.audit(frame(spark, rows), min_docs=5, top=4).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute(rows, 5, 4)


def test_empty_table(spark):
    got = D.audit(frame(spark, [("a", "en", "s")]).limit(0))
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"] and got.count() == 0
