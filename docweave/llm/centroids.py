"""Centroid clustering whose assignment is the threshold algorithm.

Vectors are integers (the floor of ``SCALE`` times a component), so sums,
means and distances are exact.  A round keeps, for each dimension, the sorted
list of the centroids' values.  A vector walks every list outward from its own
value, one entry of each list a step; a centroid met for the first time gets
its exact distance.  A centroid that no list has shown yet is at least as far
as the frontier in every dimension, so once the sum of the squared frontier
distances strictly exceeds the best exact distance, no other centroid can win
or tie, and the walk stops.

Start: the ``k`` vectors with the least SHA-256 of ``<salt>:<id>``.  A round is
one pass over the vectors in which a task sends a sum and a count for each
centroid and dimension; only these sums (k x dimensions) come to the driver.
A round that moves no centroid is the last that changes anything, so the
others are left out.

Edge cases: null vectors, vectors of another size and vectors with a null or
non-finite component are not kept; a component beyond 2^17 in size is an error,
as its squared distances need not fit a long; fewer vectors than ``k`` give as
many centroids; equal ids are ordered by their vectors at the start, and a null
id is hashed as an empty one; rows that repeat an id are rows of their own; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from docweave.llm.common import shared_table

SCALE = 1024
LIMIT = 1 << 17
#: Vectors of one step of the walk.
BLOCK = 4096


def integer_vectors(df: DataFrame, dim: int, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(vec_id, x array<int>)`` of the vectors with ``dim`` finite components."""
    v = F.col(vec_col)
    whole = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    kept = df.where((F.size(v) == dim) & F.coalesce(whole, F.lit(False)))
    too_large = F.raise_error(F.lit(f"a component beyond {LIMIT} in size"))

    def integer(c):
        return F.when(F.abs(c) > LIMIT, too_large).otherwise(F.floor(c.cast("double") * SCALE)).cast("int")

    return kept.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(v, integer).alias("x"))


def start(vectors: DataFrame, k: int, salt: str) -> np.ndarray:
    """The ``k`` vectors that come first by hash."""
    key = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(key.alias("key"), "x").orderBy("key", "x").limit(k).collect()
    return np.array([r["x"] for r in rows], np.int64)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of every row (ties: the smaller number) and its squared distance."""
    n, dim = x.shape
    k = len(centroids)
    order = np.argsort(centroids, axis=0, kind="stable")
    ends = np.full((1, dim), 1 << 40)  # past both ends of a list
    lists = np.concatenate([-ends, np.take_along_axis(centroids, order, axis=0), ends])
    above = np.stack([np.searchsorted(lists[:, d], x[:, d]) for d in range(dim)], axis=1)  # next entry upward
    below = above - 1
    dims = np.arange(dim)
    best = np.full(n, np.iinfo(np.int64).max)
    cluster = np.full(n, k, np.int64)
    seen = np.zeros((n, k), bool)
    open_ = np.arange(n)
    for _ in range(k):
        v, up, down = x[open_], above[open_], below[open_]
        to_up, to_down = lists[up, dims] - v, v - lists[down, dims]
        upward = to_up < to_down
        entry = np.where(upward, up, down) - 1
        frontier = np.where(upward, to_up, to_down)
        above[open_] = up + upward
        below[open_] = down - ~upward
        met = np.zeros((len(open_), k), bool)
        met[np.arange(len(open_))[:, None], order[entry, dims]] = True
        met &= ~seen[open_]
        seen[open_] |= met
        for c in range(k):
            at = np.flatnonzero(met[:, c])
            if not len(at):
                continue
            rows, apart = open_[at], v[at] - centroids[c]
            distance = np.einsum("ij,ij->i", apart, apart)
            wins = (distance < best[rows]) | ((distance == best[rows]) & (c < cluster[rows]))
            best[rows[wins]], cluster[rows[wins]] = distance[wins], c
        open_ = open_[(frontier * frontier).sum(axis=1) <= best[open_]]
        if not len(open_):
            break
    return cluster, best


def _blocks(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.Series, np.ndarray]]:
    for f in frames:
        for lo in range(0, len(f), BLOCK):
            part = f.iloc[lo:lo + BLOCK]
            yield part, np.stack(part["x"].to_list()).astype(np.int64)


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round: the floor of the mean of their vectors; empty ones stay."""
    k, dim = centroids.shape

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, n = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for _, x in _blocks(frames):
            cluster, _ = nearest(x, centroids)
            for c in range(k):
                own = x[cluster == c]
                sums[c] += own.sum(axis=0)
                n[c] += len(own)
        c, d = (a.ravel() for a in np.indices((k, dim)))
        out = pd.DataFrame({"c": c, "d": d, "s": sums.ravel(), "n": n[c]})
        yield out[out["n"] > 0]

    rows = vectors.select("x").mapInPandas(run, "c int, d int, s long, n long")
    total = F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")
    after = centroids.copy()
    for r in rows.groupBy("c", "d").agg(*total).collect():  # k x dim sums
        after[r["c"], r["d"]] = int(r["s"]) // r["n"]
    return after


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``(vec_id, cluster, distance)`` of every vector."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, x in _blocks(frames):
            cluster, distance = nearest(x, centroids)
            yield pd.DataFrame({"id": part["id"].to_numpy(), "no_id": part["no_id"].to_numpy(), "cluster": cluster, "distance": distance})

    # a null id travels as a flag: pandas would turn the ids beside it into floats
    known = vectors.select(F.coalesce("vec_id", F.lit(0)).alias("id"), F.col("vec_id").isNull().alias("no_id"), "x")
    out = known.mapInPandas(run, "id long, no_id boolean, cluster int, distance long")
    return out.select(F.when(~F.col("no_id"), F.col("id")).alias("vec_id"), "cluster", "distance")


def cluster(df: DataFrame, k: int = 8, rounds: int = 10, dim: int = 64, salt: str = "3", id_col: str = "vec_id",
            vec_col: str = "embedding") -> DataFrame:
    """``(vec_id, cluster, distance, centroid array<long>, cluster_inertia, inertia)`` of every kept vector."""
    spark = df.sparkSession
    vectors = shared_table(integer_vectors(df, dim, id_col, vec_col), "vectors")
    centroids = start(vectors, k, salt)
    for _ in range(rounds if len(centroids) else 0):
        after = moved(vectors, centroids)
        if (after == centroids).all():
            break
        centroids = after
    out = shared_table(assigned(vectors, centroids.reshape(-1, dim)), "assigned")
    inertia = {r["cluster"]: int(r["s"]) for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # k rows
    rows = [(c, x, inertia.get(c, 0), sum(inertia.values())) for c, x in enumerate(centroids.tolist())]
    named = spark.createDataFrame(rows, "cluster int, centroid array<long>, cluster_inertia long, inertia long")
    return out.join(F.broadcast(named), "cluster").select("vec_id", "cluster", "distance", "centroid", "cluster_inertia", "inertia")


def oracle(k: int = 8, rounds: int = 10, dim: int = 64, salt: str = "3") -> str:
    """DuckDB SQL of the same rounds, written out one after the other."""
    near = """SELECT rid, k, dist FROM (
        SELECT e.rid, c.k, sum((e.x - c.x) * (e.x - c.x)) AS dist FROM e JOIN c{0} c USING (d) GROUP BY e.rid, c.k)
      QUALIFY row_number() OVER (PARTITION BY rid ORDER BY dist, k) = 1"""
    parts = [f"""v AS MATERIALIZED (
        SELECT rid, vec_id, list(CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) ORDER BY d) AS xs
        FROM (SELECT rid, vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS d
              FROM (SELECT row_number() OVER () AS rid, * FROM embeddings))
        GROUP BY rid, vec_id HAVING count(*) = {dim} AND count(x) = {dim} AND bool_and(isfinite(x)))""",
             "e AS MATERIALIZED (SELECT rid, unnest(xs) AS x, generate_subscripts(xs, 1) AS d FROM v)",
             f"""first AS (SELECT rid, row_number() OVER (ORDER BY sha256('{salt}:' || coalesce(CAST(vec_id AS VARCHAR), '')), xs) - 1 AS k FROM v)""",
             f"c0 AS MATERIALIZED (SELECT k, d, x FROM first JOIN e USING (rid) WHERE k < {k})"]
    for r in range(rounds):
        parts.append(f"a{r} AS MATERIALIZED ({near.format(r)})")
        parts.append(f"""c{r + 1} AS MATERIALIZED (
        SELECT c.k, c.d, coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, c.x) AS x FROM c{r} c
        LEFT JOIN (SELECT k, d, sum(x) AS s, count(*) AS n FROM a{r} JOIN e USING (rid) GROUP BY k, d) m USING (k, d))""")
    parts.append(f"a AS MATERIALIZED ({near.format(rounds)})")
    parts.append(f"names AS (SELECT k, sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY d)) AS h FROM c{rounds} GROUP BY k)")
    return f"""WITH {", ".join(parts)}
      SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(dist AS BIGINT) AS distance,
             CAST(sum(dist) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(dist) OVER () AS BIGINT) AS inertia,
             h AS centroid_sha256
      FROM a JOIN v USING (rid) JOIN names USING (k)"""
