"""HTML column functions: content selection, link extraction and resolution,
markdown-lite conversion, and the non-blank predicate.

The regex chains below use only syntax that Java regexes and RE2 read the
same way (no look-around, no back-references, no ``\\b``), so DuckDB can run
the identical chain as an oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docweave.functions.urls import _col, normalize_url

# Characters Python's str.isspace() accepts; text made only of these is blank.
WHITESPACE_CLASS = (
    r"\t\n\x0b\x0c\r \x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
NONBLANK_RE = "[^" + WHITESPACE_CLASS + "]"

_BIG = 1 << 30

# Blocks removed before anything else (comments, then script/style/noscript).
STRIP_BLOCKS = [
    r"(?s)<!--.*?-->",
    r"(?is)<script(?:\s[^>]*)?>.*?</script\s*>",
    r"(?is)<style(?:\s[^>]*)?>.*?</style\s*>",
    r"(?is)<noscript(?:\s[^>]*)?>.*?</noscript\s*>",
]
BODY_OPEN = r"(?is)^.*?<body(?:\s[^>]*)?>"
BODY_CLOSE = r"(?is)</body\s*>.*$"

# markdown-lite rewrite chain; "{1}" / "{2}" stand for capture groups.
MARKDOWN_STEPS: list[tuple[str, str]] = (
    [(rf"(?i)<h{n}(?:\s[^>]*)?>", "\n\n" + "#" * n + " ") for n in range(1, 7)]
    + [
        (r"(?i)</h[1-6]\s*>", "\n\n"),
        (r"(?i)</?(?:p|div)(?:\s[^>]*)?>", "\n\n"),
        (r"(?i)<br(?:\s[^>]*)?/?>", "\n"),
        (r"(?i)<li(?:\s[^>]*)?>", "\n- "),
        (r'(?is)<a\s[^>]*?href\s*=\s*"([^"]*)"[^>]*>(.*?)</a\s*>', "[{2}]({1})"),
        (r"(?i)<(?:b|strong)>([^<]*)</(?:b|strong)>", "**{1}**"),
        (r"<[^>]*>", ""),
    ]
)
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]
WHITESPACE_STEPS = [
    (r"[ \t]+", " "),
    (r" ?\n ?", "\n"),
    (r"\n{3,}", "\n\n"),
    (r"^[ \t\r\n]+|[ \t\r\n]+$", ""),
]

LINK_RE = r"""(?i)<a\s[^>]*?href\s*=\s*["']([^"']*)"""


def java_replacement(template: str) -> str:
    return template.replace("{1}", "$1").replace("{2}", "$2")


def is_nonblank(content) -> Column:
    """Operator F8: at least one non-whitespace character (Python semantics)."""
    c = _col(content)
    return F.coalesce(c.rlike(NONBLANK_RE), F.lit(False))


def strip_noise(html) -> Column:
    """Remove comments and script/style/noscript blocks."""
    h = _col(html)
    for pat in STRIP_BLOCKS:
        h = F.regexp_replace(h, pat, "")
    return h


def body_of(html) -> Column:
    """Content of ``<body>`` (to ``</body>`` or the end); whole text if absent."""
    return F.regexp_replace(F.regexp_replace(_col(html), BODY_OPEN, ""), BODY_CLOSE, "")


def select_tag(html, tag: str) -> Column:
    """Fast path of operator H1 for one non-nesting tag: outer HTML of every
    ``<tag>…</tag>`` in document order, joined by a newline."""
    pat = rf"(?is)<{tag}(?:\s[^>]*)?>.*?</{tag}\s*>"
    return F.array_join(F.regexp_extract_all(_col(html), F.lit(pat), 0), "\n")


def to_markdown(fragment) -> Column:
    """markdown-lite (operator H3) of an HTML fragment whose comments and
    script/style blocks are already removed."""
    h = _col(fragment)
    for pat, rep in MARKDOWN_STEPS:
        h = F.regexp_replace(h, pat, java_replacement(rep))
    for ent, ch in ENTITIES:
        h = F.replace(h, F.lit(ent), F.lit(ch))
    for pat, rep in WHITESPACE_STEPS:
        h = F.regexp_replace(h, pat, rep)
    return h


def html_to_markdown(html, selected_tag: str | None = None) -> Column:
    """Whole H3 chain: strip noise, narrow to body (or to one selected tag),
    convert."""
    cleaned = strip_noise(html)
    narrowed = select_tag(cleaned, selected_tag) if selected_tag else body_of(cleaned)
    return to_markdown(narrowed)


def once(col) -> Column:
    """``col`` as the one element of a generator: a filter on the result is not
    pushed below it, so a long expression is worked out once per row and its
    code is not written twice."""
    return F.explode(F.array(_col(col)))


# ---------------------------------------------------------------- links (H2)

def extract_hrefs(html) -> Column:
    """Array of raw href values of ``<a>`` tags, after removing noise blocks."""
    return F.regexp_extract_all(strip_noise(html), F.lit(LINK_RE), 1)


def _split_ref(ref: Column):
    """(path, query-with-?, fragment-with-#) of a reference."""
    no_frag = F.substring_index(ref, "#", 1)
    frag = F.when(F.instr(ref, "#") > 0, ref.substr(F.instr(ref, "#"), F.lit(_BIG))).otherwise(F.lit(""))
    qpos = F.instr(no_frag, "?")
    path = F.when(qpos > 0, no_frag.substr(F.lit(1), qpos - 1)).otherwise(no_frag)
    query = F.when(qpos > 0, no_frag.substr(qpos, F.lit(_BIG))).otherwise(F.lit(""))
    return path, query, frag


def _remove_dot_segments(segments: Column) -> Column:
    """Resolve ``.``/``..`` over an array of path segments; returns the path."""
    resolved = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(
            s == "..", F.when(F.size(acc) > 0, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc)
        ).when(s == ".", acc).otherwise(F.concat(acc, F.array(s))),
    )
    last = F.element_at(segments, -1)
    resolved = F.when(last.isin(".", ".."), F.concat(resolved, F.array(F.lit("")))).otherwise(resolved)
    joined = F.array_join(resolved, "/")
    joined = F.when(joined == "", F.lit("/")).otherwise(joined)
    return F.when(joined.startswith("/"), joined).otherwise(F.concat(F.lit("/"), joined))


def resolve_link(base_url, href) -> Column:
    """Resolve ``href`` against an absolute http(s) page URL (RFC 3986 merge
    as done by the standard-library joiner)."""
    base = _col(base_url)
    ref = F.trim(F.replace(_col(href), F.lit("&amp;"), F.lit("&")))
    scheme = F.lower(F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    authority = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/?#]*)", 1)
    base_nofrag = F.substring_index(base, "#", 1)
    base_path = F.regexp_extract(base_nofrag, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?]*)", 1)
    base_query = F.regexp_extract(base_nofrag, r"(\?.*)$", 1)
    r_path, r_query, r_frag = _split_ref(ref)
    # merge a relative path with the base directory; interior empty segments drop
    base_dir = F.split(base_path, "/")
    base_dir = F.when(F.element_at(base_dir, -1) != "", F.slice(base_dir, 1, F.size(base_dir) - 1)).otherwise(base_dir)
    rel_segments = F.concat(base_dir, F.split(r_path, "/"))
    n = F.size(rel_segments)
    rel_segments = F.when(
        n > 2,
        F.concat(
            F.slice(rel_segments, 1, 1),
            F.filter(F.slice(rel_segments, 2, n - 2), lambda s: s != ""),
            F.slice(rel_segments, -1, 1),
        ),
    ).otherwise(rel_segments)
    abs_path = _remove_dot_segments(F.split(r_path, "/"))
    rel_path = _remove_dot_segments(rel_segments)
    prefix = F.concat(scheme, F.lit(":"), authority)
    has_scheme = ref.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:")
    return (
        F.when(has_scheme, ref)
        .when(ref.startswith("//"), F.concat(scheme, F.lit(":"), ref))
        .when(r_path.startswith("/"), F.concat(prefix, abs_path, r_query, r_frag))
        .when(r_path == "", F.concat(prefix, base_path, F.when(r_query != "", r_query).otherwise(base_query), r_frag))
        .otherwise(F.concat(prefix, rel_path, r_query, r_frag))
    )


def page_links(pages_df, url_col: str = "url", html_col: str = "html", id_col: str = "page_id"):
    """Operator H2: one row per anchor of each page, resolved against the page
    URL and canonicalised (P1); only http(s) targets are kept."""
    exploded = pages_df.select(
        F.col(id_col), F.col(url_col).alias("page_url"),
        F.posexplode(extract_hrefs(F.col(html_col))).alias("pos", "href"),
    )
    # The http(s) test is decided on the raw reference and the page URL, so
    # the filter stays cheap when pushed below the resolution projection
    # (filtering on the canonical link would inline the whole resolution).
    ref = F.trim(F.replace(F.col("href"), F.lit("&amp;"), F.lit("&")))
    web = F.when(ref.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), ref.rlike(r"^(?i)https?:")).otherwise(
        F.col("page_url").rlike(r"^(?i)https?:")
    )
    resolved = exploded.where(web).withColumn("resolved", resolve_link(F.col("page_url"), F.col("href")))
    return resolved.select(id_col, "page_url", "pos", "href", normalize_url(F.col("resolved")).alias("link"))
