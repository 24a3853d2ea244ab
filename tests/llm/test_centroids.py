"""Centroid clustering against brute force."""

import hashlib
import math
import random

import numpy as np
import pytest

from docweave.llm import centroids as C

VEC = "vec_id long, embedding array<float>, label int, cluster string, id string, x string"


def brute(rows, k, rounds, dim, salt):
    kept = [(i, [math.floor(1024 * float(np.float32(c))) for c in v]) for i, v in rows
            if v is not None and len(v) == dim and all(c is not None and math.isfinite(c) for c in v)]
    digest = lambda i: hashlib.sha256(f"{salt}:{'' if i is None else i}".encode()).hexdigest()
    cents = [v for _, v in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cents))
    for _ in range(rounds):
        at = [near(v)[1] for _, v in kept]
        for n in range(len(cents)):
            own = [v for (_, v), m in zip(kept, at) if m == n]
            if own:
                cents[n] = [sum(c) // len(own) for c in zip(*own)]
    last = [(i, *near(v)[::-1]) for i, v in kept]
    sums = [sum(d for _, c, d in last if c == n) for n in range(len(cents))]
    return sorted(((i, c, d, cents[c], sums[c], sum(sums)) for i, c, d in last), key=repr)


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 1, "c", "i", "x") for i, v in rows], VEC).repartition(3)
    return sorted(((r.vec_id, r.cluster, r.distance, r.centroid, r.cluster_inertia, r.inertia) for r in C.cluster(df, **options).collect()), key=repr)


def vectors(n, dim, seed):
    rng = random.Random(seed)
    centre = [[rng.uniform(-1, 1) for _ in range(dim)] for _ in range(5)]
    return [(i, [c + rng.gauss(0, 0.2) for c in rng.choice(centre)]) for i in range(n)]


@pytest.mark.parametrize("dim, k, rounds", [(6, 4, 10), (64, 8, 10), (3, 1, 2)])
def test_equals_brute_force(spark, dim, k, rounds):
    rows = vectors(150, dim, dim)
    bad = [(900, None), (901, []), (902, rows[0][1][:-1]), (903, [None, *rows[0][1][1:]]), (904, [float("nan"), *rows[0][1][1:]]),
           (905, [float("inf"), *rows[0][1][1:]]), (906, [*rows[0][1], 0.0])]
    rows += bad + [(None, rows[3][1]), (2**60 + 1, rows[4][1]), (5, rows[5][1]), (5, rows[6][1])] + [(1000 + i, rows[7][1]) for i in range(60)]
    assert run(spark, rows, k=k, rounds=rounds, dim=dim) == brute(rows, k, rounds, dim, "3")


def test_ties_equal_vectors_and_empty_centroids(spark):
    rows = [(i, [0.5, 0.5]) for i in range(20)] + [(100 + i, [-0.5, 0.5]) for i in range(3)]
    assert run(spark, rows, k=8, rounds=3, dim=2) == brute(rows, 8, 3, 2, "3")
    few = rows[:2]
    assert run(spark, few, k=8, rounds=3, dim=2) == brute(few, 8, 3, 2, "3")


def test_empty_table(spark):
    assert run(spark, [(1, [1.0])], dim=2) == []


def test_too_large_component_is_an_error(spark):
    with pytest.raises(Exception, match="beyond"):
        run(spark, [(1, [1e9, 0.0])], dim=2)


def test_walk_equals_all_distances():
    rng = np.random.default_rng(4)
    for k in (1, 2, 7, 20):
        cents = rng.integers(-6, 6, (k, 5))
        x = rng.integers(-8, 8, (500, 5))
        all_ = ((x[:, None, :] - cents[None]) ** 2).sum(axis=2)
        cluster, distance = C.nearest(x, cents)
        assert (cluster == all_.argmin(axis=1)).all() and (distance == all_.min(axis=1)).all()
