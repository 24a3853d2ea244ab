"""The pipeline on planted documents, stage by stage and as a whole."""

from collections import Counter

import regex
from pyspark.sql import functions as F

import corpus_pipeline as P
from docweave.llm import fuzzy_lines as L
from docweave.llm import quality
from docweave.llm.common import shared_table
from docweave.llm.queries import site
from docweave.sources.tables import table

BASE = "/root/testdata/sf0.01"  # enough labels to learn from
LINE = "a planted line that many pages of the same site carry at their very end"


def planted(spark, out):
    docs = table(spark, BASE, "documents")
    good = table(spark, BASE, "labels").where("quality = 1 AND toxic = 0")
    texts = [r.text for r in docs.join(good, "doc_id").where(F.length("text") > 600).orderBy("doc_id").limit(6).collect()]
    item = max((r.text for r in table(spark, BASE, "benchmark").collect() if r.text), key=len)
    rows = [(9001, texts[0] + "\n" + LINE), (9002, texts[1] + "\n" + LINE.upper()), (9003, texts[2] + "\n" + item), (9004, texts[3]), (9005, texts[3]),
            (None, texts[4] + "\n" + LINE + "!"), (9006, None), (9007, ""), (9008, texts[5]), (9008, texts[5])]
    extra = spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in rows], docs.schema)
    docs.union(extra).write.parquet(f"{out}/documents.parquet")
    for name in ("labels", "benchmark"):
        table(spark, BASE, name).write.parquet(f"{out}/{name}.parquet")
    return item


def shingles(text):
    w = [x for x in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if x]
    return {" ".join(w[i:i + 5]) for i in range(len(w) - 4)}


def keyed(df):
    return Counter((r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect())


def test_stages_on_planted_documents(spark, tmp_path):
    planted(spark, str(tmp_path))
    sf = str(tmp_path)
    docs = table(spark, sf, "documents")
    names = [n for n, _ in P.STAGES]
    assert names == ["quality_classifier", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "mixing"]
    seen = {}
    for name, stage in P.STAGES[:-1]:
        out = shared_table(stage(spark, docs, sf), f"test-{name}")
        assert out.columns == docs.columns
        seen[name], docs = (keyed(docs), keyed(out)), out

    before, after = seen["quality_classifier"]
    assert not after - before and 0 < len(after) < len(before)
    toxic = {r.doc_id for r in table(spark, sf, "labels").where("toxic = 1").collect()}
    gone = {i for i, _ in before - after}
    assert toxic & gone  # how many is measured, not tested: see the README
    raw = table(spark, sf, "documents")
    decided = quality.classify(raw, table(spark, sf, "labels"), *site(raw))
    assert Counter(i for i, _ in after.elements()) == Counter(r.doc_id for r in decided.where("keep").collect())

    before, after = seen["line_dedup"]
    lines = lambda c: Counter(b" ".join(L.normalised(x)) for (_, t), n in c.items() for x in t.split("\n") if L.normalised(x))
    assert Counter(i for i, _ in before.elements()) == Counter(i for i, _ in after.elements())
    assert lines(after).keys() <= lines(before).keys() and lines(after)[LINE.encode()] <= 1
    assert max(lines({k: 1 for k in after}).values()) == 1

    before, after = seen["simhash_near_dedup"]
    texts = Counter(t for _, t in after)
    assert not after - before and max(texts.values()) == 1 and max(after.values()) == 1

    before, after = seen["benchmark_decontamination"]
    items = [s for s in (shingles(r.text) for r in table(spark, sf, "benchmark").collect()) if s]
    bad = {k for k in before if any(len(s & shingles(k[1])) >= 0.8 * len(s) - 1e-9 for s in items)}
    assert after == Counter({k: n for k, n in before.items() if k not in bad}) and bad

    rows = P.STAGES[-1][1](spark, docs, sf).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in after.elements())
    assert all(r.rate >= 0 and abs(r.copies - r.rate) < 1 for r in rows)


def test_stages_on_an_empty_table(spark, tmp_path):
    planted(spark, str(tmp_path))
    docs = table(spark, str(tmp_path), "documents").limit(0)
    for name, stage in P.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.count() == 0, name
