"""Quality classifier with hierarchical empirical Bayes over sites.

Document evidence: two logistic models (quality and toxicity) over surface
features and two learned word lists.  The word lists hold the words that
labelled documents of one class use far more than the others; the models are
fitted on at most ``fit_rows`` labelled documents (least text hash first,
equal texts once), everything else reads all rows.

Site evidence: the mean of a site's document posteriors, summed by host and
by path (grouped aggregates).  A host is shrunk toward the global mean and a
path toward its host, with a strength estimated from the spread of the sites
(method of moments), so sparse sites take the prior.  A document's log odds
are moved by the log odds of its path against the global mean, at most by
``site_bound``: a site can tip a doubtful document, not condemn a clear one.

Edge cases: a null text is empty and gets the features of an empty text; a
null host or path is a site of its own; labels with nulls, of unknown
documents or repeated are allowed (nulls are not used); without labelled
documents of both classes the models answer 0.5 and every document stays; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from docweave.llm.common import passing_tables, plain_words, shared_table, small_side, utf8

FIT_ROWS = 20_000
#: Tasks that read the sample of labelled documents.
SAMPLE_TASKS = 32
LIST_WORDS = 2_000
MIN_DOCS = 5
MIN_LOG_ODDS = 3.5
SITE_BOUND = 1.0
RIDGE = 1e-4
PREFIXES = (4, 5, 6, 7, 8)
SYMBOLS = re.compile(rb"[^\w\s\x80-\xff]")
MARKS = re.compile(rb"[^\w\s\x80-\xff.,;:'\"?()-]")
DIGITS = re.compile(rb"[0-9]")
SHOUTS = re.compile(rb"(?<![a-z])[A-Z]{2,}(?![a-z])")
N_SURFACE = 11


def surface(raw: bytes, words: list[bytes]) -> list[float]:
    """Features that need no training."""
    n, size = max(1, len(words)), max(1, len(raw))
    counts = Counter(words)
    top = max(counts.values(), default=0)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    pairs = Counter(zip(words, words[1:]))
    return [
        math.log1p(len(words)),
        len(SYMBOLS.findall(raw)) / n,
        len(MARKS.findall(raw)) / n,
        len(SHOUTS.findall(raw)) / n,
        len(counts) / n,
        top / n if len(words) > 4 else 0.0,
        sum(map(len, words)) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        sum(c for c in pairs.values() if c > 1) / n,
        len(DIGITS.findall(raw)) / size,
        raw.count(b"|") / n,
    ]


def terms(words: list[bytes]) -> set[bytes]:
    """What the lists are made of: words, and heads of words (inflected and compound forms share them)."""
    own = set(words)
    return own.union(b"^" + w[:n] for w in set(words) for n in PREFIXES if len(w) > n)


class Model(NamedTuple):
    """Word weights and a logistic model for each target."""

    lists: list[dict[bytes, float]]
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # (targets, features + 1)

    def features(self, texts) -> np.ndarray:
        out = np.zeros((len(texts), N_SURFACE + 3 * len(self.lists)))
        for i, text in enumerate(texts):
            raw = utf8(text)
            words = plain_words(raw)
            row = surface(raw, words)
            own = terms(words)
            for words_of in self.lists:
                hit = [words_of[w] for w in own.intersection(words_of)]
                row += [math.log1p(len(hit)), max(hit, default=0.0), sum(hit) / math.sqrt(1 + len(words))]
            out[i] = row
        return out

    def probabilities(self, texts) -> np.ndarray:
        if not len(texts):
            return np.zeros((0, len(self.weights)))
        x = (self.features(texts) - self.mean) / self.scale
        z = np.clip(x @ self.weights[:, 1:].T + self.weights[:, 0], -30, 30)
        return 1 / (1 + np.exp(-z))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    """Newton steps for a ridge logistic model; the first weight is the intercept."""
    x1 = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x1.shape[1])
    penalty = np.full(x1.shape[1], ridge * len(x))
    penalty[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        step = np.linalg.solve((x1 * (p * (1 - p) + 1e-9)[:, None]).T @ x1 + np.diag(penalty), x1.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def word_counts(sample: DataFrame, targets: list[str]) -> DataFrame:
    """``(word, n0, n1, t0_0, t0_1, ...)``: documents with the word by half of
    the sample, in all and of class 1 of each target."""
    names = ["n", *(f"t{k}_" for k in range(len(targets)))]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            seen = {f"{n}{h}": Counter() for n in names for h in (0, 1)}
            for text, h, *ys in zip(f["text"], f["half"], *(f[t] for t in targets)):
                own = terms(plain_words(utf8(text)))
                seen[f"n{h}"].update(own)
                for k, y in enumerate(ys):
                    if y == 1:
                        seen[f"t{k}_{h}"].update(own)
            words = list(seen["n0"].keys() | seen["n1"].keys())
            yield pd.DataFrame({"word": words, **{n: [c[w] for w in words] for n, c in seen.items()}})

    cols = [f"{n}{h}" for n in names for h in (0, 1)]
    rows = sample.select("text", "half", *targets).mapInPandas(run, "word binary, " + ", ".join(f"{c} long" for c in cols))
    return rows.groupBy("word").agg(*[F.sum(c).alias(c) for c in cols])


def word_list(counts: DataFrame, sizes: dict, k: int, halves: tuple[int, ...], words: int) -> dict[bytes, float]:
    """Words whose document frequency in class 1 of target ``k`` exceeds that of
    the others by ``MIN_LOG_ODDS``, counted in the given halves of the sample."""
    add = lambda n: sum(F.col(f"{n}{h}") for h in halves)
    n1 = sum(n for (h, *ys), n in sizes.items() if h in halves and ys[k] == 1)
    n0 = sum(n for (h, *_), n in sizes.items() if h in halves) - n1
    rows = counts.select("word", add(f"t{k}_").alias("hit"), (add("n") - add(f"t{k}_")).alias("miss"))
    lo = F.log((F.col("hit") + 0.5) / (n1 + 1)) - F.log((F.col("miss") + 0.5) / (n0 + 1))
    top = rows.where(F.col("hit") >= MIN_DOCS).withColumn("lo", lo).where(F.col("lo") > MIN_LOG_ODDS)
    return {bytes(r["word"]): r["lo"] for r in top.orderBy(F.desc("lo"), "word").limit(words).collect()}  # LIST_WORDS at most


def fit(docs: DataFrame, labels: DataFrame, targets: list[str], id_col: str = "doc_id", text_col: str = "text",
        fit_rows: int = FIT_ROWS, words: int = LIST_WORDS) -> Model | None:
    """Fit on at most ``fit_rows`` labelled documents; None without both classes.
    A label of 1 is the class whose probability the model gives.

    A list's own documents would overstate it, so the weights are fitted on
    lists that the other half of the sample gave; the model takes the lists
    of the whole sample."""
    known = labels.select(F.col(id_col).alias("_label_id"), *[F.col(t).cast("int").alias(t) for t in targets]).dropna().dropDuplicates(["_label_id"])
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("text")).withColumn("_h", F.xxhash64("text"))
    # ids and hashes choose the sample; of equal texts the one with the least id gives the label
    chosen = rows.select("_id", "_h").join(known, F.col("_id") == F.col("_label_id")).groupBy("_h").agg(F.min(F.struct("_id", *targets)).alias("_s"))
    chosen = shared_table(chosen.select("_h", "_s.*").orderBy("_h").limit(fit_rows), "chosen")
    # fit_rows narrow rows at most go to every task, so that only the sample's texts are moved, to be spread over tasks
    sample = rows.join(small_side(chosen, chosen.count()), ["_id", "_h"]).dropDuplicates(["_h"])
    sample = sample.withColumn("half", F.pmod(F.xxhash64("_h"), F.lit(2)).cast("int")).repartition(SAMPLE_TASKS, "_h")
    sample = shared_table(sample.select("_h", "text", *targets, "half"), "labelled")
    sizes = {tuple(r)[:-1]: r["count"] for r in sample.groupBy("half", *targets).count().collect()}  # classes
    if any(len({key[k + 1] for key in sizes}) < 2 for k in range(len(targets))):
        return None
    counts = shared_table(word_counts(sample, targets), "words")
    lists = {halves: [word_list(counts, sizes, k, halves, words) for k in range(len(targets))] for halves in ((0,), (1,), (0, 1))}
    blank = {h: Model(lists[(1 - h,)], np.zeros(1), np.ones(1), np.zeros((len(targets), 1))) for h in (0, 1)}

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for h in (0, 1):
                own = f[f["half"] == h]
                if len(own):  # an empty column would have no list type
                    x = pd.Series(list(blank[h].features(own["text"])), dtype=object)
                    yield pd.DataFrame({"x": x, **{t: own[t].to_numpy() for t in targets}})

    got = sample.mapInPandas(run, "x array<double>, " + ", ".join(f"{t} int" for t in targets)).toPandas()  # fit_rows at most
    x = np.array(got["x"].tolist())
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    x = (x - mean) / scale
    return Model(lists[(0, 1)], mean, scale, np.array([_logistic(x, got[t].to_numpy(float), RIDGE) for t in targets]))


def probabilities(text: Column, model: Model | None, n: int) -> Column:
    """``array<double>``: the probability of each target."""
    if model is None:
        return F.array(*[F.lit(0.5)] * n)

    @F.pandas_udf("array<double>")
    def run(t: pd.Series) -> pd.Series:
        return pd.Series(list(model.probabilities(t)), dtype=object)

    return run(F.coalesce(text, F.lit("")))


def _strength(sites: DataFrame, size: str, mean: str, prior: Column) -> float:
    """Prior strength from the spread of site means around their prior (moments)."""
    v = prior * (1 - prior)
    r = sites.select(F.sum(F.pow(F.col(mean) - prior, 2) * F.col(size)).alias("s"), F.sum(v).alias("v"),
                     F.sum(v * F.col(size)).alias("vn"), F.count("*").alias("k")).first()
    if not r["k"] or not r["vn"]:
        return 1.0
    # E[n (mean - prior)^2] = v (1 + (n - 1) rho), rho = 1 / (strength + 1)
    rho = (r["s"] - r["v"]) / max(r["vn"] - r["v"], 1e-9)
    return float(1 / min(max(rho, 1e-4), 0.99) - 1)


def site_posteriors(scores: DataFrame) -> DataFrame:
    """``(host, path, n, host_rate, path_rate, global_rate)`` from ``(host, path, p)``."""
    paths = shared_table(scores.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"))
    total = paths.agg(F.sum("n"), F.sum("s")).first()
    rate = float(total[1] / total[0]) if total[0] else 0.5
    k = _strength(hosts.withColumn("m", F.col("hs") / F.col("hn")), "hn", "m", F.lit(rate))
    hosts = hosts.select(F.col("host").alias("_h"), ((F.col("hs") + k * rate) / (F.col("hn") + k)).alias("host_rate"))
    sites = paths.join(hosts, F.col("host").eqNullSafe(F.col("_h"))).drop("_h")
    k2 = _strength(sites.withColumn("m", F.col("s") / F.col("n")), "n", "m", F.col("host_rate"))
    return sites.select("host", "path", "n", "host_rate", ((F.col("s") + k2 * F.col("host_rate")) / (F.col("n") + k2)).alias("path_rate"),
                        F.lit(rate).alias("global_rate"))


def _odds(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def with_sites(rows: DataFrame, sites: DataFrame, bound: float = SITE_BOUND) -> DataFrame:
    """Rows with ``host, path, p_quality, p_toxic`` joined to their site's posterior and decided."""
    s = shared_table(sites.select(F.col("host").alias("_h"), F.col("path").alias("_p"), "host_rate", "path_rate", "global_rate"), "sites")
    out = rows.join(small_side(s, s.count()), F.col("host").eqNullSafe(F.col("_h")) & F.col("path").eqNullSafe(F.col("_p")), "left").drop("_h", "_p")
    shift = F.greatest(F.lit(-bound), F.least(F.lit(bound), _odds(F.col("path_rate")) - _odds(F.col("global_rate"))))
    out = out.withColumn("posterior", 1 / (1 + F.exp(-(_odds(F.col("p_quality")) + shift))))
    return out.withColumn("keep", (F.col("posterior") >= 0.5) & (F.col("p_toxic") <= 0.5))


def classify(docs: DataFrame, labels: DataFrame, host: Column, path: Column, id_col: str = "doc_id", text_col: str = "text",
             carry: bool = False, **options) -> DataFrame:
    """Each row's ``p_quality, p_toxic, host_rate, path_rate, global_rate,
    posterior, keep`` beside its id, or beside all of its columns (``carry``)."""
    with passing_tables(docs.sparkSession):
        model = fit(docs, labels, ["quality", "toxic"], id_col, text_col, **options)
    site = F.struct(host.cast("string").alias("host"), path.cast("string").alias("path"))
    scored = docs.select(*([F.struct("*").alias("_row")] if carry else [F.col(id_col).alias("doc_id")]), site.alias("_site"),
                         probabilities(F.col(text_col), model, 2).alias("_p"))
    narrow = lambda df: df.select(*[c for c in ("_row", "doc_id") if c in df.columns], "_site.host", "_site.path",
                                  F.col("_p")[0].alias("p_quality"), F.col("_p")[1].alias("p_toxic"))
    rows = narrow(scored)
    rows = shared_table(rows, "quality", "zstd")  # every text is scored once
    good = (F.col("p_quality") * (1 - F.col("p_toxic"))).alias("p")
    return with_sites(rows, site_posteriors(rows.select("host", "path", good)))


def keep_good(docs: DataFrame, labels: DataFrame, host: Column, path: Column, **options) -> DataFrame:
    """The rows of ``docs`` (all columns) that the classifier keeps."""
    return classify(docs, labels, host, path, carry=True, **options).where("keep").select("_row.*")
