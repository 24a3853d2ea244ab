"""Quality classifier: held-out accuracy, shrinkage, edge cases."""

import numpy as np
from pyspark.sql import functions as F

from docweave.llm import quality as Q
from docweave.sources.tables import table
from llm_fixtures import docs  # noqa: F401

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    train = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0)
    got = Q.classify(docs, train, docs["source"], docs["lang"]).join(labels.join(train, "doc_id", "left_anti"), "doc_id").toPandas()
    good = (got.quality == 1) & (got.toxic == 0)
    assert (got.keep == good).mean() > 0.97
    assert got.keep[got.toxic == 1].mean() < 0.08 and got.keep[good].mean() > 0.97


def test_sparse_sites_shrink_toward_the_prior(spark):
    rows = [("big", "big/a", 0.9)] * 400 + [("bad", "bad/a", 0.2)] * 400 + [("tiny", "tiny/a", 0.2)]
    got = {r.host: r for r in Q.site_posteriors(spark.createDataFrame(rows, "host string, path string, p double")).collect()}
    assert abs(got["bad"].path_rate - 0.2) < 0.05
    assert abs(got["tiny"].path_rate - got["tiny"].global_rate) < abs(got["bad"].path_rate - got["bad"].global_rate)


def _plain_sites(rows):
    """``{(host, path): (host_rate, path_rate, global_rate)}`` with plain loops."""
    def strength(groups):  # (size, mean, prior) of each site
        s = sum(n * (m - p) ** 2 for n, m, p in groups)
        v = sum(p * (1 - p) for _, _, p in groups)
        vn = sum(p * (1 - p) * n for n, _, p in groups)
        rho = (s - v) / max(vn - v, 1e-9)
        return 1 / min(max(rho, 1e-4), 0.99) - 1

    rate = sum(p for *_, p in rows) / len(rows)
    of_host, of_path = {}, {}
    for h, path, p in rows:
        of_host.setdefault(h, []).append(p)
        of_path.setdefault((h, path), []).append(p)
    k = strength([(len(ps), sum(ps) / len(ps), rate) for ps in of_host.values()])
    host = {h: (sum(ps) + k * rate) / (len(ps) + k) for h, ps in of_host.items()}
    k2 = strength([(len(ps), sum(ps) / len(ps), host[h]) for (h, _), ps in of_path.items()])
    return {(h, path): (host[h], (sum(ps) + k2 * host[h]) / (len(ps) + k2), rate) for (h, path), ps in of_path.items()}


def test_posteriors_equal_plain_loops(spark):
    r = np.random.RandomState(4)
    lean = {h: r.beta(2, 2) for h in ["a", "b", "c", None]}
    rows = []
    for _ in range(600):
        h = [*lean][r.choice(4, p=[0.6, 0.2, 0.15, 0.05])]
        path = None if r.random_sample() < 0.1 else f"{h}/{r.randint(0, 4)}"
        rows.append((h, path, float(np.clip(r.normal(lean[h], 0.2), 0.01, 0.99))))
    want = _plain_sites(rows)
    sites = Q.site_posteriors(spark.createDataFrame(rows, "host string, path string, p double"))
    got = {(s.host, s.path): (s.host_rate, s.path_rate, s.global_rate) for s in sites.collect()}
    assert got.keys() == want.keys()
    assert max(abs(x - y) for key in want for x, y in zip(got[key], want[key])) < 1e-9

    odds = lambda p: np.log(min(max(p, 1e-6), 1 - 1e-6) / (1 - min(max(p, 1e-6), 1 - 1e-6)))
    docs = [(i, h, path, p, 0.7 if i % 9 == 0 else 0.1) for i, (h, path, p) in enumerate(rows)]
    df = spark.createDataFrame(docs, "id long, host string, path string, p_quality double, p_toxic double")
    seen = {d.id: d for d in Q.with_sites(df, sites).collect()}
    for i, h, path, p, toxic in docs:
        _, own, rate = want[h, path]
        x = 1 / (1 + np.exp(-(odds(p) + min(max(odds(own) - odds(rate), -Q.SITE_BOUND), Q.SITE_BOUND))))
        assert abs(seen[i].posterior - x) < 1e-9 and seen[i].keep == (x >= 0.5 and toxic <= 0.5)


def test_equal_texts_with_unlike_labels_and_the_bound(spark, docs):
    rng = np.random.RandomState(1)
    rows = [(i, f"good plain words number {i}" if i % 2 else f"BUY!! spam $$ {i}") for i in range(60)] + [(100, "same"), (101, "same")]
    labels = spark.createDataFrame([(i, i % 2, 1 - i % 2) for i, _ in rows], "doc_id long, quality int, toxic int")
    models = [Q.fit(d, labels, ["quality", "toxic"], fit_rows=40) for d in (docs(rows), docs([rows[i] for i in rng.permutation(len(rows))]))]
    assert np.allclose(models[0].weights, models[1].weights, atol=1e-6)  # the same sample whatever the order of rows


def test_logistic_fit():
    r = np.random.RandomState(0)
    x = r.normal(size=(4000, 2))
    y = (r.random_sample(4000) < 1 / (1 + np.exp(-(0.5 + 2 * x[:, 0])))).astype(float)
    w = Q._logistic(x, y, 1e-6)
    assert np.abs(w - [0.5, 2, 0]).max() < 0.2


def test_edge_cases(spark, docs):
    df = docs([(1, None), (2, ""), (2, ""), (None, "some text"), (3, "w " * 20000)])
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, None, 0), (99, 0, 1)], "doc_id long, quality int, toxic int")
    out = Q.keep_good(df, labels, df["source"], F.lit(None).cast("string"))
    assert out.columns == df.columns and out.count() == 5  # labels of one class: everything stays
    empty = docs([])
    assert Q.classify(empty, labels, empty["source"], empty["lang"]).count() == 0
