"""Mixing: targets, rates against a dense solver, edge cases."""

import numpy as np

from docweave.llm import mixing as M
from llm_fixtures import docs  # noqa: F401

EN, FR = "the cat and the dog were with this house ", "le chat et les oiseaux étaient dans une maison "


def dense(tokens, posterior, targets, steps=200_000, size=0.5):
    """Plain projected gradient in the same metric, without acceleration."""
    rate = np.ones(len(tokens))
    for _ in range(steps):
        gap = (tokens * rate) @ posterior / tokens.sum() - targets
        if np.abs(gap).max() < 1e-7:
            break
        rate = np.maximum(0, rate - size * posterior @ gap)
    return rate


def run(spark, docs, targets, rows=None):
    rows = rows or [(i, EN * (i % 5 + 1)) for i in range(30)] + [(i + 30, FR * (i % 3 + 1)) for i in range(8)] + [(50, EN * 4 + FR * 4), (51, None), (51, None), (None, EN)]
    labelled = spark.createDataFrame([("en", EN * 3), ("fr", FR * 3), (None, "x"), ("en", None)], "domain string, text string")
    return M.mix(docs(rows), labelled, targets)


def test_expected_shares_meet_targets(spark, docs):
    got = run(spark, docs, {"en": 1.0, "fr": 1.0}).toPandas()
    p = np.array([[x["en"], x["fr"]] for x in got.posterior])
    tokens = got.n_tokens.to_numpy(float)
    assert np.abs((tokens * got.rate) @ p / tokens.sum() - 0.5).max() < 2e-4
    assert np.abs(got.rate - dense(tokens, p, np.array([0.5, 0.5]))).max() < 0.01
    both = got[got.doc_id == 50].posterior.iloc[0]
    assert 0.3 < both["en"] < 0.7
    assert (got.rate >= 0).all() and (np.abs(got.copies - got.rate) < 1).all()


def test_unreachable_domain_and_rates_stay_nonnegative(spark, docs):
    got = run(spark, docs, {"en": 0.0, "fr": 0.5, "xx": 0.5}).toPandas()
    en = got[(got.domain == "en") & (got.doc_id != 50)]
    assert en.rate.min() >= 0 and en.rate.max() < 0.05


def test_empty_tables(spark, docs):
    assert run(spark, docs, {"en": 1.0}, rows=[(1, "")]).count() == 1
    labelled = spark.createDataFrame([], "domain string, text string")
    assert M.mix(docs([]), labelled, {"en": 1.0, "fr": 1.0}).count() == 0
    assert M.mix(docs([(1, EN)]), labelled, {"en": 1.0, "fr": 1.0}).count() == 1


def test_domains_of_small_share_meet_targets(spark):
    targets = np.array([0.4, 0.2, 0.2, 0.2])
    for share in (0.01, 0.001):
        tokens = [int(1e6 * (1 - 3 * share))] + [int(1e6 * share)] * 3
        rows = spark.createDataFrame([(n, [float(i == k) for i in range(4)]) for k, n in enumerate(tokens)], "n_tokens long, posterior array<double>")
        moves, residual = M.fit_rates(rows, targets)
        rate = M.replay(np.eye(4), moves)[0]
        assert np.abs(rate * tokens / sum(tokens) - targets).max() < 2e-4 and residual <= M.TOLERANCE


def test_a_target_out_of_reach_leaves_a_residual(spark):
    rows = spark.createDataFrame([(100, [0.5, 0.5])], "n_tokens long, posterior array<double>")
    assert abs(M.fit_rates(rows, np.array([0.8, 0.2]), stall=5)[1] - 0.3) < 1e-3


def test_a_rare_label_counts(spark):
    labelled = spark.createDataFrame([("fr", FR)], "domain string, text string").union(
        spark.range(2_000_000).selectExpr("'en'", "'a'"))
    assert M.fit_domains(labelled, ["en", "fr", "xx"])[2].tolist() == [True, True, False]
