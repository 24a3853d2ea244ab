"""Job-spec source (K-S1) and sitemap source (K-S2).

A job spec is JSON with camelCase or snake_case keys.  It is read with an
explicit superset schema (never inferred: inference drops absent keys) and
each setting is resolved as ``coalesce(camel, snake, default)``.  Specs can
come from files (``multiLine`` JSON) or from a string column, so many specs
are parsed in parallel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.constants import (
    DEFAULT_INCLUDE_EXTERNAL,
    DEFAULT_INCLUDE_SUBDOMAINS,
    DEFAULT_MAX_DEPTH,
    DEFAULT_MAX_PAGES,
    DEFAULT_OUTPUT_FORMAT,
    DEFAULT_PERSISTENCE_STRATEGY,
    DEFAULT_SKIP_REGEX,
    DEFAULT_THREADS,
    SITEMAP_NAMESPACE,
)
from docweave.functions.content import once
from docweave.functions.urls import normalize_url

S, B, I, D = T.StringType(), T.BooleanType(), T.IntegerType(), T.DoubleType()

RATE_LIMITER = T.StructType([
    T.StructField("base_delay", T.ArrayType(D)),
    T.StructField("max_delay", D),
    T.StructField("max_retries", I),
    T.StructField("rate_limit_codes", T.ArrayType(I)),
])

ITEM = T.StructType([
    T.StructField("url", S),
    T.StructField("isSitemap", B), T.StructField("is_sitemap", B),
    T.StructField("shouldScrap", B), T.StructField("should_scrap", B),
    T.StructField("selectors", T.ArrayType(S)),
    T.StructField("includeExternal", B), T.StructField("include_external", B),
    T.StructField("includeSubdomains", B), T.StructField("include_subdomains", B),
    T.StructField("maxDepth", I), T.StructField("max_depth", I),
    T.StructField("maxPages", I), T.StructField("max_pages", I),
    T.StructField("pathsToSkipRegex", S), T.StructField("paths_to_skip_regex", S),
    T.StructField("outputFormat", S), T.StructField("output_format", S),
])

SPEC = T.StructType([
    T.StructField("persistenceStrategy", S), T.StructField("persistence_strategy", S),
    T.StructField("defaults", T.StructType([
        T.StructField("threads", I),
        T.StructField("rateLimiter", RATE_LIMITER), T.StructField("rate_limiter", RATE_LIMITER),
        T.StructField("outputFormat", S), T.StructField("output_format", S),
    ])),
    T.StructField("items", T.ArrayType(ITEM)),
    T.StructField("youtube", T.ArrayType(S)),
])


def read_spec_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per spec file, parsed with the explicit schema; a missing
    path fails before any job runs."""
    return spark.read.schema(SPEC).option("multiLine", True).option("mode", "FAILFAST").json(path)


def parse_spec_text(df: DataFrame, text_col: str = "spec_json") -> DataFrame:
    """Parse a column of spec JSON strings into the spec struct columns."""
    return df.withColumn("__spec", F.from_json(F.col(text_col), SPEC)).select("*", "__spec.*").drop("__spec")


def _pick(camel: Column, snake: Column, default) -> Column:
    return F.coalesce(camel, snake, F.lit(default))


def spec_settings(spec: DataFrame) -> DataFrame:
    """Spec-level settings with defaults: persistence strategy, threads,
    default output format."""
    d = F.col("defaults")
    return spec.withColumn("persistence", _pick(F.col("persistenceStrategy"), F.col("persistence_strategy"), DEFAULT_PERSISTENCE_STRATEGY)).withColumn(
        "threads", F.coalesce(d["threads"], F.lit(DEFAULT_THREADS))
    ).withColumn("default_format", _pick(d["outputFormat"], d["output_format"], DEFAULT_OUTPUT_FORMAT))


def spec_items(spec: DataFrame, keys: list[str]) -> DataFrame:
    """K-S1: one resolved row per item, ``pos`` = position in the spec (order
    matters for first-wins dedup).  Also resolves P13 (item output format
    falls back to the default when empty)."""
    s = spec_settings(spec)
    e = s.select(*keys, "persistence", "threads", "default_format", F.posexplode("items").alias("pos", "it"))
    it = F.col("it")
    item_fmt = _pick(it["outputFormat"], it["output_format"], None)
    return e.select(
        *keys, "pos", "persistence", "threads",
        it["url"].alias("url"),
        _pick(it["isSitemap"], it["is_sitemap"], False).alias("is_sitemap"),
        _pick(it["shouldScrap"], it["should_scrap"], False).alias("should_scrap"),
        F.coalesce(it["selectors"], F.array().cast("array<string>")).alias("selectors"),
        _pick(it["includeExternal"], it["include_external"], DEFAULT_INCLUDE_EXTERNAL).alias("include_external"),
        _pick(it["includeSubdomains"], it["include_subdomains"], DEFAULT_INCLUDE_SUBDOMAINS).alias("include_subdomains"),
        _pick(it["maxDepth"], it["max_depth"], DEFAULT_MAX_DEPTH).alias("max_depth"),
        _pick(it["maxPages"], it["max_pages"], DEFAULT_MAX_PAGES).alias("max_pages"),
        _pick(it["pathsToSkipRegex"], it["paths_to_skip_regex"], DEFAULT_SKIP_REGEX).alias("paths_to_skip_regex"),
        item_fmt.alias("output_format"),
        F.coalesce(F.nullif(item_fmt, F.lit("")), F.col("default_format")).alias("resolved_format"),
    )


def spec_videos(spec: DataFrame, keys: list[str]) -> DataFrame:
    """Video URLs of a spec, canonicalised (P1) but not de-duplicated."""
    return spec.select(*keys, F.posexplode(F.coalesce("youtube", F.array().cast("array<string>"))).alias("pos", "url")).select(
        *keys, "pos", once(normalize_url(F.col("url"))).alias("url")
    )


def expand_sitemaps(items: DataFrame, locs: DataFrame) -> DataFrame:
    """J1 + P14 + F6 + U1: sitemap items that are not deep give way to one item
    per ``locs(sitemap_url, pos, loc)`` of their URL: canonical URL, settings
    copied, flags cleared.  Other items pass.  ``sub`` is the place in the
    sitemap (0 for the others), so ``(pos, sub)`` keeps the order."""
    is_sitemap = F.col("is_sitemap") & ~F.col("should_scrap")
    listed = locs.select(F.col("sitemap_url").alias("url"), F.col("pos").cast("bigint").alias("sub"), "loc")
    cleared = {"url": once(normalize_url(F.col("loc"))), "is_sitemap": F.lit(False), "should_scrap": F.lit(False)}
    expanded = items.where(is_sitemap).join(listed, "url").select(
        *[cleared.get(c, F.col(c)).alias(c) for c in items.columns], "sub")
    return expanded.unionByName(items.where(~is_sitemap).withColumn("sub", F.lit(0).cast("bigint")))


def dedup_items(items: DataFrame, keys: list[str]) -> DataFrame:
    """W1 on the expanded items of each spec: the first ``(pos, sub)`` of a
    canonical URL stays, with the URL as it was written."""
    rows = items.withColumn("__ord", F.shiftleft(F.col("pos").cast("bigint"), 40) + F.col("sub"))
    first = rows.groupBy(*keys, normalize_url(F.col("url")).alias("__key")).agg(F.min("__ord").alias("__ord"))
    return rows.join(first.drop("__key"), [*keys, "__ord"], "left_semi").drop("__ord")


# ------------------------------------------------------------------ sitemaps

NAMESPACE_GUARD = r"""xmlns(:\w+)?=["']""" + SITEMAP_NAMESPACE.replace(".", r"\.") + """["']"""
LOC_SCHEMA = "url array<struct<loc:string>>, sitemap array<struct<loc:string>>"


def _loc_texts(xml: Column) -> Column:
    parsed = F.from_xml(xml, LOC_SCHEMA, {"ignoreNamespace": "true", "mode": "PERMISSIVE"})
    empty = F.array().cast("array<struct<loc:string>>")
    locs = F.concat(F.coalesce(parsed["url"], empty), F.coalesce(parsed["sitemap"], empty))
    return F.transform(locs, lambda x: F.trim(x["loc"]))


def loc_count(xml: Column) -> Column:
    """Number of non-empty ``<loc>`` entries (0 = failed or empty)."""
    found = F.size(F.filter(_loc_texts(xml), lambda x: x.isNotNull() & (x != "")))
    return F.when(xml.rlike(NAMESPACE_GUARD), F.greatest(found, F.lit(0))).otherwise(0).cast("bigint")


def sitemap_locs(sitemaps: DataFrame, xml_col: str = "xml", keys: list[str] | None = None) -> DataFrame:
    """K-S2 + F12: every ``<loc>`` of a sitemaps.org document (url set or
    index), in document order, non-empty text only.  Documents without the
    sitemaps namespace or that do not parse yield no rows (a failed sitemap
    is silently empty)."""
    return (
        sitemaps.where(F.col(xml_col).rlike(NAMESPACE_GUARD))
        .select(*(keys or []), F.posexplode(_loc_texts(F.col(xml_col))).alias("pos", "loc"))
        .where(F.col("loc").isNotNull() & (F.col("loc") != ""))
    )
