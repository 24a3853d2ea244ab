"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line with per-query wall times (warm-up excluded)."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from docweave.plans import catalog  # noqa: E402
from docweave.session import local_session  # noqa: E402

HEADLINE = [
    "url_normalize", "dedup_items", "page_markdown", "page_links", "page_fetch_results",
    "batch_stats", "filter_chain", "deep_crawl", "deep_crawl_stats", "transcript_markdown",
    "folder_documents", "flush_manifest", "domain_manifest", "sitemap_items", "stream_stats",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in catalog.QUERIES]
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2)
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.docweave.scanPartitions", cpus)
    # warm-up: JVM, code generation caches, parquet footers
    catalog.QUERIES["url_hash"](spark, sf_dir).count()
    times = {}
    for n in names:
        t0 = time.time()
        df = catalog.QUERIES[n](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[n] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
