"""DuckDB SQL fragments used by the oracle queries.

These express the same semantics as the Column functions in
``docweave.functions`` in plain SQL so an independent engine can check the
Spark results.  ``let`` binds a value to a lambda parameter to avoid
repeating sub-expressions.
"""

from __future__ import annotations

from docweave.constants import UTM_PARAMS
from docweave.functions.content import (
    BODY_CLOSE,
    BODY_OPEN,
    ENTITIES,
    LINK_RE,
    MARKDOWN_STEPS,
    NONBLANK_RE,
    STRIP_BLOCKS,
    WHITESPACE_STEPS,
)
from docweave.functions.urls import EMPTY_PARAMS_RE, HOST_RE, SCHEME_RE

_n = [0]


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def fresh(prefix: str) -> str:
    _n[0] += 1
    return f"_{prefix}{_n[0]}"


def let(expr: str, body) -> str:
    v = fresh("v")
    return f"(list_transform([{expr}], lambda {v}: {body(v)}))[1]"


def rx(s, pat: str, rep: str = "") -> str:
    return f"regexp_replace({s}, {q(pat)}, {q(rep)}, 'g')"


def dec(x: str) -> str:
    return f"url_decode(replace({x}, '+', ' '))"


def enc(x: str) -> str:
    return f"replace(url_encode({x}), '%20', '+')"


def _base_query(u: str, body) -> str:
    b = f"CASE WHEN strpos({u}, '?') > 0 THEN substr({u}, 1, strpos({u}, '?') - 1) ELSE {u} END"
    qq = f"CASE WHEN strpos({u}, '?') > 0 THEN substr({u}, strpos({u}, '?') + 1) ELSE '' END"
    return let(b, lambda bv: let(qq, lambda qv: body(bv, qv)))


def lower_scheme(b: str) -> str:
    sch = f"regexp_extract({b}, {q(SCHEME_RE)}, 1)"
    return f"CASE WHEN {sch} <> '' THEN lower({sch}) || substr({b}, length({sch}) + 1) ELSE {b} END"


def fix_base(b: str) -> str:
    return f"regexp_replace({lower_scheme(b)}, {q(EMPTY_PARAMS_RE)}, '\\1')"


def normalize_url(x: str) -> str:
    utm = "[" + ", ".join(q(n) for n in UTM_PARAMS) + "]"
    u0 = f"regexp_replace(split_part({x}, '#', 1), '/$', '')"

    def body(b, qv):
        p, e, k, i = fresh("p"), fresh("e"), fresh("k"), fresh("i")
        pairs = f"list_filter(string_split({qv}, '&'), lambda {p}: strpos({p}, '=') > 0 AND strpos({p}, '=') < length({p}))"
        kv = (
            f"list_filter(list_transform({pairs}, lambda {p}: {{'k': {dec(f'split_part({p}, {q(chr(61))}, 1)')}, "
            f"'v': {dec(f'substr({p}, strpos({p}, {q(chr(61))}) + 1)')}}}), lambda {e}: NOT list_contains({utm}, {e}.k))"
        )

        def with_kv(kvv):
            def with_keys(ks):
                e2 = fresh("e")
                nq = (
                    f"array_to_string(flatten(list_transform(list_filter({ks}, lambda {k}, {i}: list_position({ks}, {k}) = {i}), "
                    f"lambda {k}: list_transform(list_filter({kvv}, lambda {e2}: {e2}.k = {k}), lambda {e2}: "
                    f"{enc(e2 + '.k')} || '=' || {enc(e2 + '.v')}))), '&')"
                )
                return let(nq, lambda nqv: f"CASE WHEN {nqv} = '' THEN {fix_base(b)} ELSE {fix_base(b)} || '?' || {nqv} END")

            e3 = fresh("e")
            return let(f"list_transform({kvv}, lambda {e3}: {e3}.k)", with_keys)

        return let(kv, with_kv)

    return let(u0, lambda u: _base_query(u, body))


def cleanup_url(x: str) -> str:
    u0 = f"regexp_replace(split_part({x}, '#', 1), '/$', '')"

    def body(b, qv):
        p, k, i = fresh("p"), fresh("k"), fresh("i")
        pairs = f"list_filter(string_split({qv}, '&'), lambda {p}: strpos({p}, '=') > 0 AND NOT starts_with(split_part({p}, '=', 1), 'utm_'))"

        def with_pairs(ps):
            p2 = fresh("p")

            def with_keys(ks):
                p3 = fresh("p")
                nq = (
                    f"array_to_string(list_transform(list_filter({ks}, lambda {k}, {i}: list_position({ks}, {k}) = {i}), "
                    f"lambda {k}: list_filter({ps}, lambda {p3}: split_part({p3}, '=', 1) = {k})[-1]), '&')"
                )
                return let(nq, lambda nqv: f"CASE WHEN {nqv} = '' THEN {fix_base(b)} ELSE {fix_base(b)} || '?' || {nqv} END")

            return let(f"list_transform({ps}, lambda {p2}: split_part({p2}, '=', 1))", with_keys)

        return let(pairs, with_pairs)

    return f"CASE WHEN {x} IS NULL OR {x} = '' THEN {x} ELSE {let(u0, lambda u: _base_query(u, body))} END"


def url_host(x: str) -> str:
    return f"lower(regexp_replace(regexp_extract({x}, {q(HOST_RE)}, 1), '^\\[(.*)\\]$', '\\1'))"


def domain(x: str) -> str:
    return f"regexp_replace({url_host(x)}, '^www\\.', '')"


def same_domain(a: str, b: str) -> str:
    return let(domain(a), lambda d1: let(domain(b), lambda d2: f"coalesce({d1} <> '' AND {d1} = {d2}, false)"))


def is_subdomain(a: str, b: str) -> str:
    return let(
        domain(a),
        lambda d1: let(
            domain(b), lambda d2: f"coalesce({d1} <> '' AND {d2} <> '' AND ({d1} = {d2} OR ends_with({d1}, '.' || {d2})), false)"
        ),
    )


def sanitize(x: str, max_len: int = 120) -> str:
    s0 = rx(rx(rx(x, r"[^a-zA-Z0-9\-_.]", "_"), "_+", "_"), "^_+|_+$", "")

    def body(s):
        def with_ext(ext):
            short = f"strpos({s}, '.') > 0 AND length({ext}) < 10"
            stem = f"left({s}, length({s}) - length({ext}) - 1)"
            cut = f"CASE WHEN {short} THEN left({stem}, {max_len} - length({ext}) - 1) || '.' || {ext} ELSE left({s}, {max_len}) END"
            t = f"CASE WHEN length({s}) > {max_len} THEN {cut} ELSE {s} END"
            return let(t, lambda tv: f"CASE WHEN {tv} = '' THEN 'unnamed' ELSE {tv} END")

        return let(f"regexp_extract({s}, '([^.]*)$', 1)", with_ext)

    return let(s0, body)


def url_path(x: str) -> str:
    u = f"split_part(split_part({x}, '#', 1), '?', 1)"
    u = f"regexp_replace({u}, '^[A-Za-z][A-Za-z0-9+.-]*:', '')"
    u = f"regexp_replace({u}, '^//[^/?#]*', '')"
    return f"regexp_replace({u}, ';[^/]*$', '')"


def file_name(x: str, ext: str = ".md") -> str:
    raw = let(url_path(x), lambda p: f"CASE WHEN {p} = '' OR {p} = '/' THEN 'index' ELSE replace(regexp_replace({p}, '^/+', ''), '/', '_') END")
    return let(sanitize(raw), lambda n: f"CASE WHEN ends_with({n}, {q(ext)}) THEN {n} ELSE {n} || {q(ext)} END")


def domain_dir(x: str) -> str:
    return let(domain(x), lambda d: f"CASE WHEN {d} = '' THEN 'unknown' ELSE {d} END")


def output_path(base: str, x: str) -> str:
    return f"{q(base)} || '/' || {domain_dir(x)} || '/' || {file_name(x)}"


def document_path(base: str, x: str) -> str:
    name = let(file_name(x), lambda n: f"CASE WHEN length({n}) > 120 THEN left({n}, 87) || '_' || left(md5({x}), 8) || '.md' ELSE {n} END")
    return f"{q(base)} || '/' || {domain_dir(x)} || '/' || {name}"


def size_label(n: str) -> str:
    units = ["B", "KB", "MB", "GB", "TB", "PB"]
    v = f"CAST({n} AS DOUBLE)"
    parts = []
    for i, unit in enumerate(units):
        scaled = f"({v} / {float(1024 ** i)})"
        lab = f"printf('%.1f {unit}', {scaled})"
        if i < len(units) - 1:
            parts.append(f"WHEN {scaled} < 1024.0 THEN {lab}")
        else:
            parts.append(f"ELSE {lab}")
    return "CASE " + " ".join(parts) + " END"


def nonblank(x: str) -> str:
    return f"coalesce(regexp_matches({x}, {q(NONBLANK_RE)}), false)"


def strip_noise(x: str) -> str:
    for pat in STRIP_BLOCKS:
        x = rx(x, pat)
    return x


def body_of(x: str) -> str:
    return rx(rx(x, BODY_OPEN), BODY_CLOSE)


def select_tag(x: str, tag: str) -> str:
    pat = rf"(?is)<{tag}(?:\s[^>]*)?>.*?</{tag}\s*>"
    return f"array_to_string(regexp_extract_all({x}, {q(pat)}, 0), chr(10))"


def to_markdown(x: str) -> str:
    for pat, rep in MARKDOWN_STEPS:
        x = rx(x, pat, rep.replace("{1}", "\\1").replace("{2}", "\\2"))
    for ent, ch in ENTITIES:
        x = f"replace({x}, {q(ent)}, {q(ch)})"
    for pat, rep in WHITESPACE_STEPS:
        x = rx(x, pat, rep)
    return x


def html_to_markdown(x: str, tag: str | None = None) -> str:
    cleaned = strip_noise(x)
    return to_markdown(select_tag(cleaned, tag) if tag else body_of(cleaned))


def hrefs(x: str) -> str:
    return f"regexp_extract_all({strip_noise(x)}, {q(LINK_RE)}, 1)"
