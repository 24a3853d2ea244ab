"""URL filter chain (operators F1-F5, F7, F8, F13) as Column predicates.

Filters are per item: candidates are joined to their item on ``item_id`` (an
equi-join) and the predicates below read the item's settings as columns, so
no regex nested loop is ever planned.  Domain filters need no regex at all:
the subdomain pattern ``^.*\\.?D(:\\d+)?.*`` holds exactly when ``D`` occurs in
the URL, and the exact-domain pattern ``^https?://(www\\.)?D`` is a prefix
test.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.functions.content import is_nonblank
from docweave.functions.urls import _col, extract_domain, url_host

# A filter is a function (candidate url column) -> boolean Column, reading item
# columns that are in scope after the item join.
UrlFilter = Callable[[Column], Column]


def item_domain(seed_url) -> Column:
    """Domain of an item seed; null when the seed has no host (invalid seed)."""
    d = F.regexp_replace(url_host(seed_url), r"^www\.", "")
    return F.nullif(d, F.lit(""))


def regex_is_valid(pattern) -> Column:
    """True when the pattern compiles as a Java regex (checked in the task,
    not on the driver); invalid skip patterns are reported and ignored."""
    p = _col(pattern)
    compiled = F.call_function("try_reflect", F.lit("java.util.regex.Pattern"), F.lit("compile"), p)
    return compiled.isNotNull()


def _rlike(u: Column, p: Column) -> Column:
    return F.call_function("rlike", u, p)


def skip_filter(url, pattern, valid) -> Column:
    """block a URL when the item's skip pattern is found in it; an empty
    or invalid pattern blocks nothing."""
    u, p, ok = _col(url), _col(pattern), _col(valid)
    blocked = F.when((F.coalesce(p, F.lit("")) == "") | ~ok, F.lit(False)).otherwise(_rlike(u, p))
    return ~blocked


def subdomain_filter(url, domain) -> Column:
    """F2 (literal pattern semantics): the item domain occurs in the URL."""
    return F.coalesce(F.instr(_col(url), _col(domain)) > 0, F.lit(False))


def exact_domain_filter(url, domain) -> Column:
    """``http(s)://`` + optional ``www.`` + the item domain as a prefix."""
    u, d = _col(url), _col(domain)
    rest = F.regexp_replace(u, r"^https?://", "")
    has_scheme = u.rlike(r"^https?://")
    after_www = F.when(rest.startswith("www."), rest.substr(F.lit(5), F.lit(1 << 30)))
    return F.coalesce(has_scheme & (rest.startswith(d) | F.coalesce(after_www.startswith(d), F.lit(False))), F.lit(False))


def external_filter(url, seed_url, include_external) -> Column:
    """unless external links are allowed, the URL must be on the seed's
    domain or a subdomain of it (can only restrict further)."""
    d1, d2 = extract_domain(url), extract_domain(seed_url)
    inside = (d1 != "") & (d2 != "") & ((d1 == d2) | d1.endswith(F.concat(F.lit("."), d2)))
    return F.coalesce(_col(include_external) | inside, F.lit(False))


def filter_chain(
    url,
    *,
    domain="domain",
    skip="paths_to_skip_regex",
    skip_valid="regex_valid",
    include_subdomains="include_subdomains",
    include_external="include_external",
    seed_url="seed_url",
    extra: list[UrlFilter] | None = None,
) -> Column:
    """AND of the skip filter, the domain filter chosen by
    ``include_subdomains`` and the external-link condition, plus any extra
    filters (the composable extension point)."""
    u = _col(url)
    dom = F.when(_col(include_subdomains), subdomain_filter(u, domain)).otherwise(exact_domain_filter(u, domain))
    cond = skip_filter(u, skip, skip_valid) & dom & external_filter(u, seed_url, include_external)
    for f in extra or []:
        cond = cond & f(u)
    return cond


def with_item_checks(items: DataFrame, url_col: str = "url") -> DataFrame:
    """Add ``seed_url``, ``domain`` (null = invalid seed) and ``regex_valid``."""
    return items.withColumn("seed_url", F.col(url_col)).withColumn("domain", item_domain(F.col(url_col))).withColumn(
        "regex_valid", regex_is_valid(F.coalesce(F.col("paths_to_skip_regex"), F.lit("")))
    )


def fetch_status(success, content) -> Column:
    """failed / skipped (blank content) / success."""
    return (
        F.when(~F.coalesce(_col(success), F.lit(False)), F.lit("failed"))
        .when(~is_nonblank(content), F.lit("skipped"))
        .otherwise(F.lit("success"))
    )


def split_flat_deep(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """flat items (not deep-crawled) and deep items."""
    return items.where(~F.col("should_scrap")), items.where(F.col("should_scrap"))
