"""Repeated byte strings against brute force."""

import hashlib
import random
from collections import Counter

import pytest

from docweave.llm import repeats as R
from llm_fixtures import docs  # noqa: F401


def brute(texts, length=200):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(raw[i:i + length] for raw in raws for i in range(len(raw) - length + 1))
    out = []
    for raw in raws:
        mark = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if seen[raw[i:i + length]] > 1:
                mark[i:i + length] = b"\1" * length
        kept = bytes(b for b, m in zip(raw, mark) if not m)
        runs = sum(1 for i, m in enumerate(mark) if m and (not i or not mark[i - 1]))
        out.append((len(raw), len(raw) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return out


def corpus():
    rng = random.Random(3)
    make = lambda n: " ".join(rng.choice(["the", "thé", "ion", "ation", "ß", "q"]) + str(rng.randint(0, 999)) for _ in range(n))
    p, q = make(60), make(45)
    texts = [make(rng.randint(1, 120)) for _ in range(15)]
    texts += [texts[3], texts[3], None, "", "a" * 500, "ab" * 300, make(40) + p + make(40), p[:199], p[:200], q + q, "x" * 199, p + make(5) + q]
    texts += [make(rng.randint(0, 20)) + p + make(rng.randint(0, 20)) for _ in range(20)]
    for _ in range(10):
        k = rng.randint(0, len(texts[7]) - 1)
        texts.append(texts[7][:k] + rng.choice("abc") + texts[7][k + 1:])
    return texts


@pytest.mark.parametrize("bucket_rows", [R.BUCKET_ROWS, 5])
def test_removal_equals_brute_force(docs, bucket_rows):
    texts = corpus()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest())
           for r in R.remove_repeats(docs(texts), bucket_rows=bucket_rows).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts)


def test_repeated_rows_and_null_ids(docs):
    text = " ".join(f"w{i}" for i in range(90))
    got = R.remove_repeats(docs([(1, text), (1, text), (None, "only " + "x1 y2 z3 " * 10), (None, "other")])).collect()
    assert sorted((r.doc_id is None, r.n_removed) for r in got) == [(False, len(text))] * 2 + [(True, 0)] * 2


@pytest.mark.parametrize("bucket_rows", [R.BUCKET_ROWS, 2])
def test_different_texts_of_one_id(docs, bucket_rows):
    rng = random.Random(9)
    make = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    p, q = make(419), make(300)
    texts = [make(90) + p + make(40), make(500) + p, q + make(150) + p, make(260), q, make(30) + q + make(30), None]
    rows = list(zip([1, 1, 1, 1, 2, None, 1], texts))
    got = R.remove_repeats(docs(rows), bucket_rows=bucket_rows).collect()
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got) == sorted(brute(texts))


def test_groups_list_all_occurrences(docs):
    rng = random.Random(5)
    make = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    p = make(230)
    texts = [make(150) + p + make(150) for _ in range(4)] + [make(300)]
    rows = R.repeat_occurrences(docs(texts)).collect()
    raw = [t.encode() for t in texts]
    groups = {}
    for r in rows:
        groups.setdefault(r.repeat_id, set()).add((r.uid, raw[r.uid][r.start:r.start + r.length]))
    assert all(len({s for _, s in g}) == 1 for g in groups.values())
    assert any({u for u, _ in g} == {0, 1, 2, 3} for g in groups.values())
    assert all(r.length >= 200 for r in rows)


def test_segments_of_long_texts():
    rng = random.Random(1)
    raw = bytes(rng.randrange(97, 123) for _ in range(30_000))
    whole = R.anchors(raw)
    keep, R.SEGMENT = R.SEGMENT, 4096
    try:
        parts = R.anchors(raw)
    finally:
        R.SEGMENT = keep
    assert set(whole[0].tolist()) == set(parts[0].tolist())


def test_interval_scan():
    assert sorted(R.prefix_intervals([1, 3, 3, 0, 2])) == [(0, 0, 5), (1, 0, 3), (2, 4, 5), (3, 1, 3)]


def test_empty_table(docs):
    assert R.remove_repeats(docs([])).count() == 0


def test_copied_documents_that_share_a_passage(docs):
    rng = random.Random(6)
    make = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    p = make(300)
    one, two = make(200) + p + make(200), make(200) + p + make(200)
    groups = {}
    for r in R.repeat_occurrences(docs([one, two, one, two])).collect():
        groups.setdefault(r.repeat_id, set()).add(r.uid)
    assert {frozenset(g) for g in groups.values()} == {frozenset({0, 2}), frozenset({1, 3}), frozenset({0, 1, 2, 3})}
