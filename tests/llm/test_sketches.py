"""Invertible sketches and fingerprints of versions."""

import hashlib
import random

import numpy as np

from docweave.llm import sketches as S
from llm_fixtures import docs  # noqa: F401


def test_peeling_recovers_the_difference_at_every_size():
    r = np.random.RandomState(1)
    for n, d in [(0, 0), (5, 0), (40, 3), (40, 40), (300, 250)]:
        a, b = S.Version(""), S.Version("")
        both = r.randint(1, 2**62, n).astype(np.uint64)
        extra = r.randint(1, 2**62, d).astype(np.uint64)
        a.keys, b.keys = np.unique(np.append(both, extra[: d // 2])), np.unique(np.append(both, extra[d // 2:]))
        mine, theirs = S.difference(a, b)
        assert set(mine) == set(a.keys) - set(b.keys) and set(theirs) == set(b.keys) - set(a.keys)


def likeness(a, b):
    x, y = set(S.digests(a)), set(S.digests(b))
    return 1 - len(x ^ y) / (len(x) + len(y)) if x or y else 1.0


def test_versions_equal_brute_force(docs):
    rng = random.Random(1)
    make = lambda: "\n".join(" ".join(rng.choice("abcdé") * 2 + str(rng.randint(0, 99)) for _ in range(rng.randint(1, 90))) for _ in range(rng.randint(0, 9)))
    texts = {i * 7 % 101: make() for i in range(60)}
    texts |= {200: None, 201: "", 202: texts[0], 203: texts[0], 204: "x" * 5000}
    got = {r.doc_id: r for r in S.fingerprint_versions(docs(list(texts.items()))).collect()}
    order = sorted(texts)
    for i, nxt in zip(order, order[1:] + order[:1]):
        text, following = texts[i] or "", texts[nxt] or ""
        changed = text[:len(text) - len(text) // 2] + following[:len(text) // 2]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (S.Version(text).fingerprint(), S.Version(changed).fingerprint())
        assert abs(r.near_edited - likeness(text, changed)) < 1e-12 and abs(r.near_next - likeness(text, following)) < 1e-12
    assert got[202].fingerprint == got[203].fingerprint and got[202].near_next == 1.0


def test_edge_tables(docs):
    one = S.fingerprint_versions(docs([(5, "alone in the table")])).collect()
    assert [(r.doc_id, r.near_next) for r in one] == [(5, 1.0)]
    rows = S.fingerprint_versions(docs([(None, "a b"), (1, "c d"), (1, "c d"), (2, "e f"), (2, "e f")])).collect()
    assert sorted((r.doc_id or 0) for r in rows) == [0, 1, 1, 2, 2]
    assert S.fingerprint_versions(docs([])).count() == 0


def test_many_pairs_are_peeled_together(monkeypatch):
    rng, peeled = random.Random(4), []
    words = lambda n: " ".join(str(rng.randint(0, 10**6)) for _ in range(n))
    versions = [S.Version(words(rng.choice([0, 3, 40, 400, 3000]))) for _ in range(40)]
    versions += [S.Version(words(40) + "\n" + words(900)) for _ in range(20)] + versions[:5]
    pairs = [*zip(versions, versions[1:]), (versions[0], versions[0])]
    real = S.Sketches.peel
    monkeypatch.setattr(S.Sketches, "peel", lambda self: peeled.append(len(self.count)) or real(self))
    for most in (S.MOST_CELLS, 1):
        monkeypatch.setattr(S, "MOST_CELLS", most)
        for (a, b), (mine, theirs) in zip(pairs, S.differences(pairs)):
            assert set(mine) == set(a.keys) - set(b.keys) and set(theirs) == set(b.keys) - set(a.keys)
            assert len(mine) == len(set(mine)) and len(theirs) == len(set(theirs))
        if most > 1:
            assert len(peeled) < 12 < max(peeled)


def test_ranges_are_dealt_evenly(docs):
    n = int(docs([]).sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = S.fingerprint_versions(docs([(i * 3, f"text {i}") for i in range(100 * n)]))
    sizes = [r["count"] for r in found.groupBy(S.F.spark_partition_id()).count().collect()]
    assert len(sizes) == n and sum(sizes) == 100 * n and max(sizes) <= 150
