"""File-name and output-path column functions, and byte-size labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docweave.constants import (
    BYTE_UNITS,
    FILENAME_INVALID_CHARS,
    INDEX_FILE,
    LAST_BYTE_UNIT,
    LONG_NAME_KEEP,
    MARKDOWN_EXTENSION,
    MAX_EXTENSION_LENGTH,
    MAX_FILENAME_LENGTH,
    UNKNOWN_DOMAIN,
    UNNAMED_FILE,
    URL_HASH_CHARS,
)
from docweave.functions.urls import _col, extract_domain

_BIG = 1 << 30


def url_path(url) -> Column:
    """Path component of a URL: no fragment, query, scheme, authority, and no
    ``;params`` of the last segment."""
    u = F.substring_index(_col(url), "#", 1)
    u = F.substring_index(u, "?", 1)
    u = F.regexp_replace(u, r"^[A-Za-z][A-Za-z0-9+.-]*:", "")
    u = F.regexp_replace(u, r"^//[^/?#]*", "")
    return F.regexp_replace(u, r";[^/]*$", "")


def sanitize_filename(name, max_length: int = MAX_FILENAME_LENGTH) -> Column:
    """Operator P6: keep ``[a-zA-Z0-9-_.]``, collapse and trim ``_``; names
    over ``max_length`` keep a short last extension; empty -> ``unnamed``."""
    s = F.regexp_replace(_col(name), FILENAME_INVALID_CHARS, "_")
    s = F.regexp_replace(s, "_+", "_")
    s = F.regexp_replace(s, "^_+|_+$", "")
    ext = F.substring_index(s, ".", -1)
    has_short_ext = (F.instr(s, ".") > 0) & (F.length(ext) < MAX_EXTENSION_LENGTH)
    keep = F.lit(max_length) - F.length(ext) - 1
    stem = s.substr(F.lit(1), F.length(s) - F.length(ext) - 1)
    truncated = F.when(
        has_short_ext, F.concat(stem.substr(F.lit(1), keep), F.lit("."), ext)
    ).otherwise(s.substr(1, max_length))
    s = F.when(F.length(s) > max_length, truncated).otherwise(s)
    return F.when(s == "", F.lit(UNNAMED_FILE)).otherwise(s)


def _file_name(url, extension: str) -> Column:
    p = url_path(url)
    raw = F.when((p == "") | (p == "/"), F.lit(INDEX_FILE)).otherwise(
        F.replace(F.regexp_replace(p, "^/+", ""), F.lit("/"), F.lit("_"))
    )
    name = sanitize_filename(raw)
    return F.when(name.endswith(extension), name).otherwise(F.concat(name, F.lit(extension)))


def _domain_dir(url) -> Column:
    d = extract_domain(url)
    return F.when(d == "", F.lit(UNKNOWN_DOMAIN)).otherwise(d)


def build_output_path(base_dir: str, url, extension: str = MARKDOWN_EXTENSION) -> Column:
    """Operator P7: ``{base}/{domain or unknown}/{sanitised path}{ext}``."""
    return F.concat_ws("/", F.lit(base_dir), _domain_dir(url), _file_name(url, extension))


def document_path(base_dir: str, url, extension: str = MARKDOWN_EXTENSION) -> Column:
    """Operator P8: as P7, but a file name longer than the limit is cut and
    suffixed with 8 hex characters of md5(url)."""
    name = _file_name(url, extension)
    long_name = F.concat(
        name.substr(1, LONG_NAME_KEEP), F.lit("_"), F.md5(_col(url)).substr(1, URL_HASH_CHARS), F.lit(extension)
    )
    name = F.when(F.length(name) > MAX_FILENAME_LENGTH, long_name).otherwise(name)
    return F.concat_ws("/", F.lit(base_dir), _domain_dir(url), name)


def format_bytes(n) -> Column:
    """Operator P11: divide by 1024 through B..TB then PB, one decimal,
    ties to even on the exact binary value."""
    v = _col(n).cast("double")
    units = BYTE_UNITS + [LAST_BYTE_UNIT]
    expr = None
    for i, unit in enumerate(units):
        scaled = v / float(1024 ** i)
        label = F.format_string("%.1f %s", F.bround(scaled, 1), F.lit(unit))
        cond = scaled < 1024.0 if i < len(units) - 1 else None
        if expr is None:
            expr = F.when(cond, label)
        elif cond is not None:
            expr = expr.when(cond, label)
        else:
            expr = expr.otherwise(label)
    return expr
