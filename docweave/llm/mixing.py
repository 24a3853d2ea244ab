"""Mixing to target weights by soft domain membership.

A classifier fitted on the labelled table gives every document a posterior
over domains: the mean, over windows of ``WINDOW`` byte pairs, of a naive
Bayes posterior over byte pairs, so a document in two domains belongs to both.  Document rates are the
projected-gradient least-squares fit of the domain token totals to the
targets, from the rate 1: minimise the squared distance between the expected
shares sum(rate * tokens * posterior) / tokens and the targets, with rates of
zero or more.  A step moves a rate by the product of its posterior and the
gap of the shares times the inverse of the curvature (the token-weighted mean
of posterior outer products, domains x domains), so small domains move as fast
as large ones.  A document's rate follows from its posterior and the moves of
all steps: each step is one aggregation over the documents, only the gaps (two
numbers a domain) come to the driver, and rates are replayed, never stored
between steps.  Steps go on until the gap is within the tolerance or ``STALL``
of them bring no gain; then the targets are out of reach, and steps without the
inverse start anew and go on in the same way toward the least squares.  A gap that is left is
in ``residual`` and a warning.
The rate is the expected number of copies; ``copies`` rounds it by a hash of
the id, so the expectation holds.

Edge cases: a null text is empty, without tokens, and has the prior as its
posterior; labels may repeat, miss documents or be null (not used); domains
without a labelled document get no tokens and their target is spread over the
others; without labels every posterior is even; an empty table gives an empty
result; rows that repeat an id get equal rates; other columns are not read.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from docweave.llm.common import shared_table, utf8

PAIRS = 1 << 16
WINDOW = 64
#: Weight of a pair's evidence: neighbouring pairs are not independent.
TEMPER = 0.25
#: Steps without a gain of a hundredth after which the targets count as out of reach.
STALL = 20
TOLERANCE = 1e-4


def _pairs(raw: bytes) -> np.ndarray:
    b = np.frombuffer(raw, np.uint8).astype(np.int32)
    return b[:-1] * 256 + b[1:]


def fit_domains(labelled: DataFrame, domains: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log prior and log byte-pair probabilities by domain, and whether it has a label, from ``(domain, text)``.

    Every labelled row counts; a task sends one table of domains x byte pairs."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, n = np.zeros((len(domains), PAIRS), np.int64), np.zeros(len(domains), np.int64)
        for f in frames:
            for text, d in zip(f["text"], f["domain"]):
                k = domains.index(d)
                p = _pairs(utf8(text).lower())
                if len(p):
                    counts[k] += np.bincount(p, minlength=PAIRS)
                n[k] += 1
        k, p = np.nonzero(counts)
        own = np.flatnonzero(n)
        yield pd.DataFrame({"k": np.concatenate([k, own]), "p": np.concatenate([p, np.full(len(own), -1)]),
                            "n": np.concatenate([counts[k, p], n[own]])})

    rows = labelled.where(F.col("domain").isin(domains)).select("domain", "text").mapInPandas(run, "k int, p int, n long")
    got = rows.groupBy("k", "p").agg(F.sum("n").alias("n")).toPandas()  # domains x byte pairs at most
    table, docs = np.zeros((len(domains), PAIRS)), np.zeros(len(domains))
    own = got["p"] < 0
    docs[got["k"][own]] = got["n"][own]
    table[got["k"][~own], got["p"][~own]] = got["n"][~own]
    table += 0.5 * table.sum(axis=0) / max(1.0, table.sum()) * 1000 + 1e-3  # smoothed toward the common distribution
    prior = (docs + 1e-9) / (docs.sum() + 1e-9 * len(docs))
    return np.log(prior), np.log(table / table.sum(axis=1, keepdims=True)), docs > 0



def with_posteriors(df: DataFrame, text: Column, prior: np.ndarray, logp: np.ndarray) -> DataFrame:
    """Add ``n_tokens`` (words) and ``posterior`` (array of doubles)."""

    @F.pandas_udf("struct<n: long, p: array<double>>")
    def run(t: pd.Series) -> pd.DataFrame:
        out = []
        for x in t:
            raw = utf8(x).lower()
            pairs = _pairs(raw)
            starts = np.arange(0, max(1, len(pairs)), WINDOW)
            seen = np.add.reduceat(logp[:, pairs], starts, axis=1) if len(pairs) else np.zeros((len(prior), 1))
            z = prior[:, None] + TEMPER * seen
            e = np.exp(z - z.max(axis=0))
            part = np.diff(np.append(starts, max(1, len(pairs))))
            p = (e / e.sum(axis=0)) @ part
            out.append((len(raw.split()), p / p.sum()))
        return pd.DataFrame(out, columns=["n", "p"])

    return df.withColumn("_m", run(F.coalesce(text, F.lit("")))).withColumns(
        {"n_tokens": F.col("_m.n"), "posterior": F.col("_m.p")}).drop("_m")


def replay(posterior: np.ndarray, moves: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Rates after the steps whose moves are given (accelerated, projected), and
    the point ahead of them at which the next gap is taken."""
    rate = ahead = np.ones(len(posterior))
    t = 1.0
    for move in moves:
        after = np.maximum(0.0, ahead - posterior @ move)
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = after + (t - 1) / t_next * (after - rate)
        rate, t = after, t_next
    return rate, ahead


def fit_rates(rows: DataFrame, targets: np.ndarray, stall: int = STALL, tolerance: float = TOLERANCE) -> tuple[list[np.ndarray], float]:
    """Moves of the projected-gradient steps over ``(n_tokens, posterior)``, and
    the largest gap between the shares they reach and the targets."""
    k = len(targets)
    total = rows.agg(F.sum("n_tokens")).first()[0] or 0
    if not total:
        return [], 0.0

    def summed(width: int, of) -> np.ndarray:
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sums = np.zeros(width)
            for f in frames:
                if len(f):
                    sums += of(f["n_tokens"].to_numpy(float), np.array(f["posterior"].tolist())).ravel()
            yield pd.DataFrame({"d": np.arange(width), "s": sums})

        got = rows.select("n_tokens", "posterior").mapInPandas(run, "d int, s double").groupBy("d").agg(F.sum("s").alias("s")).toPandas()
        return got.sort_values("d")["s"].to_numpy() / total

    # in the metric of the inverse the curvature is 1 at most, as it is without: steps of length 1
    inverse = np.linalg.pinv(summed(k * k, lambda n, p: p.T @ (n[:, None] * p)).reshape(k, k), rcond=1e-12, hermitian=True)
    for metric in (inverse, np.eye(k)):
        moves: list[np.ndarray] = []
        best, best_at = np.inf, 0
        while True:
            rate_gap, ahead_gap = summed(2 * k, lambda n, p: (n * np.array(replay(p, moves))) @ p).reshape(2, k) - targets
            left = float(np.abs(rate_gap).max())
            if left <= tolerance:
                return moves, left
            size = np.linalg.norm(rate_gap)
            if size < best * 0.99:
                best, best_at = size, len(moves)
            if len(moves) - best_at >= stall:
                break
            moves.append(metric @ ahead_gap)
    return moves, left


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text",
        stall: int = STALL, tolerance: float = TOLERANCE) -> DataFrame:
    """``(doc_id, n_tokens, posterior map<string, double>, domain, rate, copies, residual)``.

    ``labelled``: ``(domain, text)``; ``targets``: weight of each domain (scaled
    to 1).  The expected tokens of the mix equal those of ``docs``.  ``residual``
    is the largest gap between a domain's expected share and its target."""
    domains = sorted(targets)
    prior, logp, known = fit_domains(labelled, domains)
    want = np.array([targets[d] for d in domains], float) * (known if known.any() else 1)
    want = want / want.sum() if want.sum() else np.full(len(domains), 1 / len(domains))
    if not known.any():
        prior, logp = np.zeros(len(domains)), np.zeros_like(logp)
    rows = with_posteriors(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text")), F.col("_text"), prior, logp)
    rows = shared_table(rows.select("doc_id", "n_tokens", "posterior"), "posteriors")
    moves, residual = fit_rates(rows, want, stall, tolerance)
    if residual > tolerance:
        warnings.warn(f"mixing: targets out of reach, a share stays {residual:.2g} off")

    @F.pandas_udf("double")
    def rate(p: pd.Series) -> pd.Series:
        return pd.Series(replay(np.array(p.tolist()).reshape(len(p), len(domains)), moves)[0])

    names = F.array(*[F.lit(d) for d in domains])
    draw = F.pmod(F.xxhash64(F.lit("mix"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    out = rows.withColumn("rate", rate("posterior"))
    return out.select("doc_id", "n_tokens", F.map_from_arrays(names, "posterior").alias("posterior"),
                      F.get(names, (F.array_position("posterior", F.array_max("posterior")) - 1).cast("int")).alias("domain"),
                      "rate", (F.floor("rate") + (draw < F.col("rate") - F.floor("rate")).cast("long")).alias("copies"),
                      F.lit(residual).alias("residual"))
