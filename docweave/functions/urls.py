"""URL column functions (canonicalisation, cleanup, domains, hashes).

All functions take and return :class:`pyspark.sql.Column` and compile to
built-in Catalyst expressions (regexes and higher-order array functions), so
they stay inside whole-stage code generation; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docweave.constants import HASH_ALGORITHMS, UTM_PARAMS, UTM_PREFIX

SCHEME_RE = r"^([A-Za-z][A-Za-z0-9+.-]*):"
# scheme://netloc/.../last;   -> an empty ";params" on the last segment is dropped
EMPTY_PARAMS_RE = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/(?:.*/)?[^/;]*);$"
# host of an authority: optional scheme, "//", optional userinfo, [ipv6] or name
HOST_RE = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#]*@)?(\[[^\]]*\]|[^:/?#]*)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once (bound by a lambda)."""
    return F.transform(F.array(value), body)[0]


def strip_fragment(url) -> Column:
    """Everything before the first ``#``."""
    return F.substring_index(_col(url), "#", 1)


def _split_query(u: Column) -> tuple[Column, Column]:
    """(base, query) split at the first ``?``; query is '' when absent."""
    pos = F.instr(u, "?")
    base = F.when(pos > 0, u.substr(F.lit(1), pos - 1)).otherwise(u)
    query = F.when(pos > 0, u.substr(pos + 1, F.lit(1 << 30))).otherwise(F.lit(""))
    return base, query


def _lower_scheme(base: Column) -> Column:
    scheme = F.regexp_extract(base, SCHEME_RE, 1)
    return F.when(
        scheme != "",
        F.concat(F.lower(scheme), base.substr(F.length(scheme) + 1, F.lit(1 << 30))),
    ).otherwise(base)


def percent_decode(x: Column) -> Column:
    """Form-decoding: ``+`` is a space, valid ``%XX`` runs decode as UTF-8 and a
    ``%`` that does not start a valid escape is kept literally."""
    return F.url_decode(F.regexp_replace(x, r"%(?![0-9A-Fa-f]{2})", "%25"))


def form_encode(x: Column) -> Column:
    """Form-encoding: unreserved ``A-Za-z0-9_.-~`` kept, space as ``+``,
    everything else as uppercase ``%XX`` of its UTF-8 bytes."""
    return F.replace(F.replace(F.url_encode(x), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def normalize_url(url, strip_utm: bool = True) -> Column:
    """Canonical URL key (operator P1).

    Cut at the first ``#``; drop one trailing ``/``; then rebuild the query:
    blank values and key-only parameters vanish, values are grouped under their
    key in first-seen key order, the five ``utm_*`` keys are removed and the
    pairs are form-encoded again; the scheme is lower-cased and an empty
    query disappears.  Not idempotent on purpose (``x/a/?utm_source=z`` gives
    ``x/a/``).
    """
    u = F.regexp_replace(strip_fragment(url), "/$", "")
    if not strip_utm:
        return u
    base, query = _split_query(u)
    base = F.regexp_replace(_lower_scheme(base), EMPTY_PARAMS_RE, "$1")
    pairs = F.filter(
        F.split(query, "&"),
        lambda p: (F.instr(p, "=") > 0) & (F.instr(p, "=") < F.length(p)),
    )
    kv = F.transform(
        pairs,
        lambda p: F.struct(
            percent_decode(F.substring_index(p, "=", 1)).alias("k"),
            percent_decode(p.substr(F.instr(p, "=") + 1, F.lit(1 << 30))).alias("v"),
        ),
    )
    utm = F.array(*[F.lit(n) for n in UTM_PARAMS])
    kv = F.filter(kv, lambda x: ~F.array_contains(utm, x["k"]))

    def grouped(kv: Column) -> Column:
        keys = F.array_distinct(F.transform(kv, lambda x: x["k"]))
        return F.flatten(
            F.transform(
                keys,
                lambda k: F.transform(
                    F.filter(kv, lambda x: x["k"] == k),
                    lambda x: F.concat(form_encode(x["k"]), F.lit("="), form_encode(x["v"])),
                ),
            )
        )

    new_query = F.array_join(_let(kv, grouped), "&")
    return _let(new_query, lambda q: F.when(q == "", base).otherwise(F.concat(base, F.lit("?"), q)))


def cleanup_url(url, strip_utm: bool = True) -> Column:
    """Loose URL cleaner (operator P2).

    Null and empty strings are returned unchanged.  Cut at ``#``, drop one
    trailing ``/``; with ``strip_utm`` keep only ``k=v`` parameters whose key
    does not start with ``utm_``, one per key in first-seen order with the
    last value winning, no re-encoding.
    """
    src = _col(url)
    u = F.regexp_replace(strip_fragment(src), "/$", "")
    if strip_utm:
        base, query = _split_query(u)
        base = F.regexp_replace(_lower_scheme(base), EMPTY_PARAMS_RE, "$1")
        pairs = F.filter(
            F.split(query, "&"),
            lambda p: (F.instr(p, "=") > 0) & ~F.substring_index(p, "=", 1).startswith(UTM_PREFIX),
        )

        def last_of_each(pairs: Column) -> Column:
            keys = F.array_distinct(F.transform(pairs, lambda p: F.substring_index(p, "=", 1)))
            return F.transform(
                keys,
                lambda k: F.element_at(F.filter(pairs, lambda p: F.substring_index(p, "=", 1) == k), -1),
            )

        rebuilt = F.array_join(_let(pairs, last_of_each), "&")
        u = _let(rebuilt, lambda q: F.when(q == "", base).otherwise(F.concat(base, F.lit("?"), q)))
    return F.when(src.isNull() | (src == ""), src).otherwise(u)


def url_host(url) -> Column:
    """Lower-cased host name without userinfo, port or IPv6 brackets; '' if none."""
    h = F.regexp_extract(_col(url), HOST_RE, 1)
    h = F.regexp_replace(h, r"^\[(.*)\]$", "$1")
    return F.lower(h)


def extract_domain(url) -> Column:
    """Domain of a URL (operator P3): host with one leading ``www.`` removed."""
    return F.regexp_replace(url_host(url), r"^www\.", "")


def is_same_domain(url1, url2) -> Column:
    """Both domains non-empty and equal (operator P4)."""
    d1, d2 = extract_domain(url1), extract_domain(url2)
    return F.coalesce((d1 != "") & (d1 == d2), F.lit(False))


def is_subdomain(url1, url2) -> Column:
    """``url1``'s domain equals or ends with ``.`` + ``url2``'s (operator P5)."""
    d1, d2 = extract_domain(url1), extract_domain(url2)
    return F.coalesce(
        (d1 != "") & (d2 != "") & ((d1 == d2) | d1.endswith(F.concat(F.lit("."), d2))),
        F.lit(False),
    )


def content_hash(content, algorithm: str = "md5") -> Column:
    """Hex digest of the UTF-8 text (operator P9); algorithm checked up front."""
    c = _col(content)
    if algorithm == "md5":
        return F.md5(c)
    if algorithm == "sha1":
        return F.sha1(c)
    if algorithm == "sha256":
        return F.sha2(c, 256)
    raise ValueError(f"Unsupported hash algorithm: {algorithm} (use one of {HASH_ALGORITHMS})")


def url_hash(url, algorithm: str = "md5") -> Column:
    """Operator P10: :func:`content_hash` of the URL text."""
    return content_hash(url, algorithm)
