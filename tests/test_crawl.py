"""Scored best-first crawl, the co-partitioned link graph, and the one rule for captures."""

import random

import pytest
from pyspark.sql import functions as F

from docweave.operators import crawl as G
from docweave.operators import filters as FL
from docweave.operators import harvest as R
from docweave.operators import stats as ST

BASE = "https://s.com/"
ITEMS = "item_id string, url string, include_subdomains boolean, include_external boolean, paths_to_skip_regex string, max_depth int, max_pages int"


def score_of(url):
    return (len(url) * 7 + ord(url[-1]) * 13) % 11 / 10


def score_col(url):
    return F.pmod(F.length(url) * 7 + F.ascii(url.substr(-1, 1)) * 13, F.lit(11)) / F.lit(10.0)


def brute(items, edges, ok, batch):
    out = []
    for item, seed, max_depth, max_pages in items:
        frontier, visited, wins, n = {seed: 0}, set(), 0, 0
        while frontier and wins < max_pages:
            best = sorted(frontier, key=lambda u: (-score_of(u), frontier[u], u))[:batch]
            taken = []
            for u in best:
                if wins < max_pages:
                    taken.append((u, frontier.pop(u)))
                    visited.add(u)
                    wins += ok.get(u, False)
            out += [(item, u, d, ok.get(u, False), score_of(u), n) for u, d in taken]
            for u, d in taken:
                for v in edges.get(u, []) if ok.get(u, False) and d < max_depth else []:
                    if v.startswith(BASE) and v not in visited:
                        frontier[v] = min(frontier.get(v, d + 1), d + 1)
            n += 1
    return sorted(out)


def graph(n=40, seed=3):
    rng = random.Random(seed)
    nodes = [BASE + rng.choice("abcdefg") * (i % 5) + str(i) for i in range(n)]
    edges = {u: rng.sample(nodes, 4) + ["https://other.org/x"] for u in nodes}
    return nodes, edges, {u: i % 6 != 2 for i, u in enumerate(nodes)}


def frames(spark, items, edges, ok):
    i = spark.createDataFrame([(k, s, True, False, "", d, p) for k, s, d, p in items], ITEMS)
    e = spark.createDataFrame([(s, d) for s, ds in edges.items() for d in ds], "src string, dst string")
    return FL.with_item_checks(i).drop("url"), e, spark.createDataFrame(list(ok.items()), "url string, success boolean")


@pytest.mark.parametrize("batch", [1, 3, 10])
def test_scored_crawl_matches_brute_force(spark, batch):
    nodes, edges, ok = graph()
    items = [("a", nodes[0], 3, 6), ("b", nodes[1], 2, 100), ("c", nodes[2], 9, 5), ("d", nodes[3], 0, 5), ("e", nodes[4], 9, 0)]
    got = G.deep_crawl(*frames(spark, items, edges, ok), score=score_col, batch=batch)
    rows = sorted(tuple(r) for r in got.select("item_id", "url", "depth", "success", "score", "round").collect())
    assert rows == brute(items, edges, ok, batch)


def test_many_items_are_joined_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(G, "BROADCAST_ITEMS", 0)
    nodes, edges, ok = graph()
    items = [("a", nodes[0], 3, 6), ("b", nodes[1], 2, 100)]
    inputs = frames(spark, items, edges, ok)
    got = G.deep_crawl(*inputs, score=score_col, batch=3).select("item_id", "url", "depth", "success", "score", "round")
    assert sorted(tuple(r) for r in got.collect()) == brute(items, edges, ok, 3)
    monkeypatch.undo()
    rows = lambda df: sorted(tuple(r) for r in df.select("item_id", "url", "depth", "success").collect())
    few = rows(G.deep_crawl(*inputs))
    monkeypatch.setattr(G, "BROADCAST_ITEMS", 0)
    assert rows(G.deep_crawl(*inputs)) == few


def test_scores_admit_other_pages_and_reach_the_statistics(spark):
    nodes, edges, ok = graph()
    inputs = frames(spark, [("a", nodes[0], 4, 5)], edges, ok)
    scored = G.deep_crawl(*inputs, score=score_col, batch=1).withColumn("status", F.when(F.col("success"), "success").otherwise("failed"))
    plain = {r.url for r in G.deep_crawl(*inputs).where("success").collect()}
    assert plain != {r.url for r in scored.where("success").collect()} and len(plain) == 5
    mean = sum(r.score for r in scored.where("success").collect()) / 5
    assert abs(ST.deep_crawl_stats(scored).first().avg_score - mean) < 1e-12 and mean > 0


def test_scores_need_best_first(spark):
    nodes, edges, ok = graph(6)
    with pytest.raises(ValueError):
        G.deep_crawl(*frames(spark, [("a", nodes[0], 1, 1)], edges, ok), order="bfs", score=score_col)


def test_a_level_does_not_move_the_link_graph(spark):
    nodes, edges, ok = graph()
    items, e, f = frames(spark, [("a", nodes[0], 3, 6)], edges, ok)
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        graph_ = G.link_graph(e, f)
        at = spark.createDataFrame([("a", nodes[0], 0)], "item_id string, url string, depth int")
        joined = at.repartition(G._partitions(at), "url").join(graph_, F.col("url") == F.col("src"))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "SortMergeJoin" in plan
        rows = {(r.url, r.success) for r in G.followed_links(at, graph_, G._Items(items.select(*G.SETTINGS_COLS), True)).collect()}
        assert rows == {(v, ok[v]) for v in edges[nodes[0]] if v.startswith(BASE)}
    finally:
        spark.conf.set(limit, before)


def test_one_rule_for_captures_of_several_spellings(spark):
    rows = [(1, "http://x/a/", False, "<p>failed</p>"), (2, "http://x/a", True, "<p>good</p>"), (3, "http://x/a#f", True, "<p>later</p>"),
            (4, "http://x/b", False, "<p>no</p>"), (5, "http://x/c", True, "  "), (6, "http://x/c/", False, "<p>x</p>")]
    fetch = spark.createDataFrame(rows, "page_id long, url string, success boolean, html string")
    got = {r.key: (r.page_id, r.fetched, r.nonblank) for r in G.first_capture(fetch).collect()}
    assert got == {"http://x/a": (2, True, True), "http://x/b": (4, False, True), "http://x/c": (5, True, False)}
    assert {r.url: r.success for r in G.canonical_fetch(fetch).collect()} == {k: v[1] for k, v in got.items()}


def test_a_failed_first_capture_does_not_hide_the_page(spark):
    fetch = spark.createDataFrame([(1, "http://x.test/a/", False, "<p>failed</p>"), (2, "http://x.test/a", True, "<p>good</p>")],
                                  "page_id long, url string, success boolean, html string")
    cols = ("spec_id long, persistence string, pos int, sub long, url string, selectors array<string>, should_scrap boolean, "
            "include_subdomains boolean, include_external boolean, paths_to_skip_regex string, max_depth int, max_pages int")
    items = spark.createDataFrame([(1, "folder_per_domain", 0, 0, "http://x.test/a/", [], False, True, False, "", 1, 5),
                                   (1, "folder_per_domain", 1, 0, "http://x.test/a#x", [], True, True, False, "", 1, 5)], cols)
    edges = spark.createDataFrame([], "src string, dst string")
    refs = R.page_references(items, fetch, edges).collect()
    assert sorted((r.phase, r.page_id) for r in refs) == [(R.FLAT, 2), (R.DEEP, 2)]
