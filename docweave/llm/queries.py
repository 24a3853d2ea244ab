"""Registered queries of the training-data operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from docweave.llm import (
    centroids, decontaminate, divergence, fuzzy_lines, html_text, licenses, mixing, packing, quality, quotes, repeats, simhash, sketches,
)
from docweave.sources.tables import table

QUERIES = {}
ORACLES = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


#: Token shares of the mix by language.
TARGETS = {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}


#: Labelled documents the domains are fitted on; their ids (8 bytes each) are broadcast.
LABELLED_IDS = 20_000


def labelled_domains(docs, labels, ids=LABELLED_IDS):
    """``(domain, text)`` of the labelled documents, their language: those with
    the ``ids`` label ids of least hash.  The ids alone are moved, no text is."""
    known = labels.select(F.col("doc_id").alias("_label_id")).dropna().distinct().orderBy(F.xxhash64("_label_id"), "_label_id").limit(ids)
    return docs.select("doc_id", F.col("lang").alias("domain"), "text").join(F.broadcast(known), F.col("doc_id") == F.col("_label_id"), "left_semi")


@register("op1_mixing")
def op1_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    mixed = mixing.mix(docs, labelled_domains(docs, table(spark, sf_dir, "labels")), TARGETS)
    return mixed.select("doc_id", "n_tokens", *[F.col("posterior")[d].alias(f"p_{d}") for d in sorted(TARGETS)], "domain", "rate", "copies")


@register("op2_licenses")
def op2_licenses(spark, sf_dir):
    found = licenses.scan(table(spark, sf_dir, "documents"))
    base = F.filter("places", lambda p: p["phrase"])
    labels = lambda places: F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")
    starts = F.transform(base, lambda p: p["start"])
    return found.select("doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
                        F.array_max(starts).alias("last_word"), labels(base).alias("base_labels"), labels(F.col("places")).alias("labels"), "score")


@register("op3_decontamination", decontaminate.ORACLE)
def op3_decontamination(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op4_html_text")
def op4_html_text(spark, sf_dir):
    found = html_text.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "path")


@register("op5_fingerprints")
def op5_fingerprints(spark, sf_dir):
    return sketches.fingerprint_versions(table(spark, sf_dir, "documents"))


def site(docs):
    """Host and path of a document: its source, and its language within it."""
    return docs["source"], F.concat_ws("/", docs["source"], docs["lang"])


@register("op6_quality")
def op6_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality.classify(docs, table(spark, sf_dir, "labels"), *site(docs))


@register("op7_quotations")
def op7_quotations(spark, sf_dir):
    return quotes.reply_order(table(spark, sf_dir, "conversations"))


@register("op8_line_dedup")
def op8_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fuzzy_lines.dedup_lines(docs).withColumnsRenamed({"_n_lines": "n_lines", "_n_removed": "n_removed"})


@register("op9_simhash")
def op9_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


@register("op10_repeats")
def op10_repeats(spark, sf_dir):
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"), length=200)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@register("op11_divergence", divergence.ORACLE)
def op11_divergence(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"))


@register("op12_packing")
def op12_packing(spark, sf_dir):
    found = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return found.select("doc_id", "start", "length", F.crc32("tokens").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@register("op13_centroids", centroids.oracle())
def op13_centroids(spark, sf_dir):
    found = centroids.cluster(table(spark, sf_dir, "embeddings"))
    digest = F.sha2(F.array_join(F.transform("centroid", lambda x: x.cast("string")), ","), 256)
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))
