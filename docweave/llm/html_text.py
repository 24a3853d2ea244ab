"""HTML main text by consensus host paths.

Every page is read into containers and text blocks; menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles and reader comments are
left out by element, role and class words.  Inside an article or main element
a class that only holds such a word beside others (``share-price``) is no proof:
that element is left out only if half of its text or more is links.  The text of
formulas, and of noscript elements inside an article, is text.  A container is scored by its
share of the page's remaining text, its depth and its name.  The scores are
votes for its generalised path (tags and classes from the root, digits
levelled); Spark sums them for each host, and the path with the most votes
is the host's.  Pages are then read again along the winning path; a page
without it, or where it holds little, falls back to its own best container.
Containers on one path belong together, and so do articles side by side.

Edge cases: null html is empty and has an empty text; a null or odd url
counts for the host ''; repeated rows give repeated results and votes; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from docweave.llm.common import shared_table, small_side

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>|"""
    r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

# Element names and class words.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template svg iframe annotation annotation-xml".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong "
                   "sub sup time tt u var math mrow mi mn mo ms mtext mspace mfrac msqrt mroot mstyle msub msup msubsup munder mover "
                   "munderover mtable mtr mtd semantics".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
                     "h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SAME = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"),
        "option": ("select",)}
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote td th tr ul ol dl table tbody figure figcaption".split())
SKIPPED = frozenset("nav header footer aside form button select menu dialog object audio video canvas head".split()) | RAW
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form".split())
NOISE = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu "
                  "breadcrumb breadcrumbs sidebar footer header masthead banner cookie cookies consent gdpr notice notices notification "
                  "popup modal overlay newsletter subscribe signup comment comments reply replies respond disqus share sharing social "
                  "related recommended widget toolbar pagination pager login alert toast".split())
#: Words that add nothing to a class word above: a name made of both kinds only is proof enough.
PLAIN = frozenset("area bar block body bottom box btn button buttons center column container content count entries feed footnote form global "
                  "group head heading header icon icons image inline inner item items label left link links list main media message mobile "
                  "outer page panel policy post posts right row section site slot stories tags text title tool top unit video wrap "
                  "wrapper article articles".split())
COMMENT = frozenset("comment comments reply replies respond".split())
LAYOUT = frozenset("has no with without".split())
NAMED = frozenset("article content post entry story main".split())
DIGITS = re.compile(r"\d+")
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class Node:
    __slots__ = ("tag", "path", "parent", "depth", "skip", "weight", "named", "within", "doubt", "chars", "linked")

    def __init__(self, tag, path, parent, depth, skip, named):
        self.tag, self.path, self.parent, self.depth, self.skip, self.named = tag, path, parent, depth, skip, named
        self.weight = 0.0
        # inside an article or main element, and the nearest element there whose class is in doubt
        self.within = tag in ("article", "main") or parent is not None and parent.within
        self.doubt = parent.doubt if parent is not None else None
        self.chars = self.linked = 0


def _shown(tag: str, parent: Node) -> bool:
    return tag == "noscript" and parent.within


def _of_links(n: Node) -> bool:
    """Whether an element in doubt around ``n`` consists of links by half or more."""
    d = n.doubt
    while d is not None:
        if 2 * d.linked >= d.chars:
            return True
        d = d.parent.doubt
    return False


def _node(tag: str, attrs: str, parent: Node) -> Node:
    label, skip, named = tag, parent.skip or tag in SKIPPED and not _shown(tag, parent), tag in ("article", "main")
    doubtful = False
    if attrs and not attrs.isspace():
        got = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(attrs)}
        names = got.get("class", "").split()
        if names:
            label += "." + ".".join(sorted({DIGITS.sub("0", n) for n in names}))
        if got.get("role", "").lower() in ROLES or "hidden" in got or got.get("aria-hidden") == "true":
            skip = True
        for n in (*names, got.get("id", "")):
            own = [x.lower() for x in NAME_WORD.findall(n)]
            if tag in ("html", "body") or LAYOUT.intersection(own):
                continue
            words = COMMENT if tag in ("article", "main") else NOISE
            if not words.isdisjoint(own):
                proof = not parent.within or all(x in words or x in PLAIN or x.isdigit() or len(x) == 1 for x in own)
                skip, doubtful = skip or proof, doubtful or not proof
            named = named or not NAMED.isdisjoint(own)
    n = Node(tag, f"{parent.path}/{label}", parent, parent.depth + 1, skip, named)
    if doubtful:
        n.doubt = n
    return n


def page_blocks(source: str) -> tuple[list[Node], list[tuple[Node, str, float]]]:
    """Containers and text blocks ``(container, text, weight)`` in page order.
    The weight of a block is its length without link text."""
    root = Node("", "", None, 0, False, False)
    nodes, stack = [root], [root]
    blocks: list[tuple[Node, str, float]] = []
    held: list[str] = []
    linked, links, home = 0, 0, root

    def flush():
        nonlocal held, linked
        if held:
            text = " ".join(entities.unescape("".join(held)).split())
            if text and not home.skip:
                blocks.append((home, text, max(0.0, len(text) - 2.0 * linked)))
                d = home.doubt
                while d is not None:
                    d.chars, d.linked = d.chars + len(text), d.linked + linked
                    d = d.parent.doubt
        held, linked = [], 0

    def start():
        nonlocal home
        if not held:
            home = stack[-1]
            while home.tag in INLINE:
                home = home.parent

    def shut(i: int):
        nonlocal links
        links -= sum(n.tag == "a" for n in stack[i:])
        del stack[i:]

    at, end = 0, len(source)
    while at < end:
        m = TOKEN.search(source, at)
        text = source[at:m.start() if m else end]
        if text:
            start()
            if not stack[-1].skip:
                held.append(text)
                linked += len(text.strip()) if links else 0
        if not m:
            break
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            inner = tag in INLINE
            if not inner:
                flush()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    shut(i)
                    break
                if inner and stack[i].tag not in INLINE:
                    break
            continue
        if tag == "br":
            start()
            if not stack[-1].skip:
                held.append("\n")
            continue
        if tag in INLINE:
            n = _node(tag, m[3] or m[6] or "", stack[-1])
            if n.skip != stack[-1].skip:
                flush()
            stack.append(n)
            links += tag == "a"
            continue
        flush()
        if tag in VOID:
            continue
        if tag in CLOSES_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    shut(i)
                    break
                if stack[i].tag not in INLINE:
                    break
        elif tag in SAME:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag or tag in ("td", "th") and stack[i].tag in ("td", "th") or tag in ("dt", "dd") and stack[i].tag in ("dt", "dd"):
                    shut(i)
                    break
                if stack[i].tag in SAME[tag]:
                    break
        attrs = m[3] or m[6] or ""
        if tag in RAW and not _shown(tag, stack[-1]):
            if not attrs.endswith("/"):
                close = re.compile(rf"</{tag}\b[^>]*>", re.I).search(source, at)
                at = close.end() if close else end
            continue
        parent = stack[-1]
        n = _node(tag, attrs, parent)
        stack.append(n)
        nodes.append(n)
    flush()
    return nodes, [b for b in blocks if not _of_links(b[0])]


def _container(n: Node) -> Node:
    while n.tag in LEAVES and n.parent is not None:
        n = n.parent
    return n


def scored(source: str) -> tuple[list[tuple[Node, float]], list[tuple[Node, str, float]]]:
    """Scored containers of a page, and its blocks."""
    nodes, blocks = page_blocks(source)
    total = sum(w for _, _, w in blocks)
    if not total:
        return [], blocks
    for home, _, w in blocks:
        n = _container(home)
        while n is not None:
            n.weight += w
            n = n.parent
    out = []
    for n in nodes:
        if n.weight > 0 and not n.skip and n.tag not in LEAVES:
            share = n.weight / total
            # the whole page is no container of its own unless nothing below it holds most of the text
            base = 0.7 if n.tag in ("", "html", "body") else 1.0
            out.append((n, share * share * (base + 0.1 * n.depth + (0.5 if n.named else 0.0))))
    return out, blocks


def main_text(source: str, path: str | None) -> str:
    """Text of the containers on ``path``, or of the page's own best container."""
    found, blocks = scored(source)
    if not found:
        return " ".join(t for _, t, _ in blocks)
    best = max(found, key=lambda x: x[1])[0]
    chosen = {id(n) for n, _ in found if n.path == path}
    held = sum(n.weight for n, _ in found if n.path == path)
    if held < 0.2 * best.weight or not chosen:
        beside = best.tag == "article"
        chosen = {id(n) for n, _ in found if n.path == best.path or beside and n.tag == "article" and n.parent is best.parent}

    def inside(n):
        while n is not None:
            if id(n) in chosen:
                return True
            n = n.parent
        return False

    return " ".join(t for home, t, _ in blocks if inside(home))


def host(url):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]+)", 1)), F.lit(""))


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(host, path, votes)``: the winning container path of each host."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [(h, n.path, x) for h, source in zip(f["host"], f["html"]) for n, x in scored(source or "")[0]]
            # votes of a batch are summed before they are moved
            yield pd.DataFrame(rows, columns=["host", "path", "votes"]).groupby(["host", "path"], as_index=False).sum()

    votes = pages.select(host(F.col(url_col)).alias("host"), F.coalesce(html_col, F.lit("")).alias("html")).mapInPandas(
        run, "host string, path string, votes double")
    votes = votes.groupBy("host", "path").agg(F.round(F.sum("votes"), 6).alias("votes"))
    # greatest votes, then the least path: negated votes in a minimum keep it a plain aggregate
    best = votes.groupBy("host").agg(F.min(F.struct((-F.col("votes")).alias("v"), "path")).alias("b"))
    return best.select("host", "b.path", (-F.col("b.v")).alias("votes"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, path)`` for every page row."""
    paths = shared_table(host_paths(pages, url_col, html_col).select(F.col("host").alias("_host"), F.col("path").alias("_path")), "host-paths")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(html_col, F.lit("")).alias("_html"))
    rows = rows.join(small_side(paths, paths.count()), host(F.col("url")) == F.col("_host"), "left")

    @F.pandas_udf("string")
    def text_of(source: pd.Series, path: pd.Series) -> pd.Series:
        return pd.Series([main_text(s, p) for s, p in zip(source, path)], dtype=object)

    return rows.select("page_id", "url", text_of("_html", "_path").alias("text"), F.col("_path").alias("path"))
