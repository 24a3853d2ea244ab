"""General content selection (operator H1, extension point X4).

Selectors: compounds of ``tag``, ``*``, ``.class``, ``#id`` and attribute tests
(``[href]``, ``[lang=en]``, ``~= ^= $= *= |=``), paths of them (descendants and
``>`` children) and comma lists.  The result is the outer HTML of the matching
elements: selector order first, then document order; a match inside an element
that is already kept is dropped.  Runs as an Arrow-batched pandas UDF (the HTML
tree cannot be expressed with regexes); the single-tag case has a JVM fast
path in :func:`docweave.functions.content.select_tag`.
"""

from __future__ import annotations

import re
from functools import lru_cache
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
# start tags that implicitly close an open <p>
CLOSES_P = {
    "address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4",
    "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul",
}
#: One compound: tag or *, then classes, ids and attribute tests.
COMPOUND_RE = re.compile(r"""([A-Za-z][\w-]*|\*)?((?:[.#][\w-]+|\[\s*[\w:-]+\s*(?:[~^$*|]?=\s*(?:"[^"]*"|'[^']*'|[\w-]+)\s*)?\])*)""")
PART_RE = re.compile(r"""([.#])([\w-]+)|\[\s*([\w:-]+)\s*(?:([~^$*|]?=)\s*(?:"([^"]*)"|'([^']*)'|([\w-]+))\s*)?\]""")
TESTS = {
    "=": lambda have, want: have == want,
    "~=": lambda have, want: want in have.split(),
    "^=": lambda have, want: bool(want) and have.startswith(want),
    "$=": lambda have, want: bool(want) and have.endswith(want),
    "*=": lambda have, want: bool(want) and want in have,
    "|=": lambda have, want: have == want or have.startswith(want + "-"),
}


def _compound(text: str):
    """``(tag, [(attribute, test, value)])`` of the compound at the start of ``text``, and the rest; None if there is none."""
    m = COMPOUND_RE.match(text)
    if not m.group(0):
        return None
    tests = []
    for kind, name, attr, op, *values in PART_RE.findall(m.group(2)):
        if kind:
            tests.append(("class", TESTS["~="], name) if kind == "." else ("id", TESTS["="], name))
        else:
            tests.append((attr.lower(), TESTS[op] if op else None, "".join(values)))
    tag = (m.group(1) or "*").lower()
    return (None if tag == "*" else tag, tests), text[m.end():]


class Automaton:
    """All selectors of a list as one machine.  A state is a compound that may
    match next; an open element carries two bit sets, the states for all of its
    descendants and those for its children only, so one pass over the tags
    decides every selector."""

    def __init__(self, selectors: tuple[str, ...]):
        self.compounds: list = []  # (test, bit of the next state, next is for children, bits of the selectors that end here)
        self.start = 0
        for i, selector in enumerate(selectors):
            for path in self._paths(selector):
                first = len(self.compounds)
                self.start |= 1 << first
                for k, (test, child) in enumerate(path):
                    end = k == len(path) - 1
                    self.compounds.append((test, 0 if end else 1 << (first + k + 1), child, 1 << i if end else 0))

    @staticmethod
    def _paths(selector: str):
        """Each path of a comma list as ``[(compound, is the next one a child)]``."""
        paths, path, rest = [], [], selector.strip()
        while True:
            got = _compound(rest)
            if got is None:
                raise ValueError(f"unsupported selector: {selector!r}")
            test, tail = got
            m = re.match(r"\s*([>,])\s*|\s+", tail)
            path.append((test, bool(m) and m.group(1) == ">"))
            if not tail:
                return paths + [path]
            if not m:
                raise ValueError(f"unsupported selector: {selector!r}")
            if m.group(1) == ",":
                paths, path = paths + [path], []
            rest = tail[m.end():]

    def step(self, states: int, tag: str, attrs: dict) -> tuple[int, int, int]:
        """Selectors that match an element, and what it adds for descendants and for children."""
        hits = below = children = 0
        while states:
            low = states & -states
            states ^= low
            (want, tests), after, child, ends = self.compounds[low.bit_length() - 1]
            if (want is None or want == tag) and all(
                n in attrs and (test is None or test(attrs[n] or "", value)) for n, test, value in tests
            ):
                hits |= ends
                if child:
                    children |= after
                else:
                    below |= after
        return hits, below, children


@lru_cache(maxsize=1024)
def automaton(selectors: tuple[str, ...]) -> Automaton | None:
    """The machine of a selector list, or None if one of them is not supported."""
    try:
        return Automaton(selectors)
    except ValueError:
        return None


@lru_cache(maxsize=1024)
def is_compound(selector: str) -> bool:
    got = _compound(selector.strip())
    return got is not None and not got[1]


class _Elements(HTMLParser):
    """Collect ``(start, end, hits)`` of the elements that match, with simple implied-end rules."""

    def __init__(self, text: str, machine: Automaton):
        super().__init__(convert_charrefs=False)
        self.text = text
        self.machine = machine
        self.line_starts = [0] + [i + 1 for i, ch in enumerate(text) if ch == "\n"]
        self.stack: list[tuple] = []  # (tag, start, hits, states of descendants, states of children)
        self.done: list[tuple[int, int, int]] = []

    def _offset(self) -> int:
        line, col = self.getpos()
        return self.line_starts[line - 1] + col

    def _close_to(self, idx: int, end: int) -> None:
        while len(self.stack) > idx:
            self._add(self.stack.pop()[1:3], end)

    def _add(self, element, end: int) -> None:
        start, hits = element
        if hits:
            self.done.append((start, end, hits))

    def _open(self, tag, attrs, start: int) -> tuple:
        below, children = self.stack[-1][3:] if self.stack else (self.machine.start, 0)
        hits, more, own = self.machine.step(below | children, tag, dict(attrs))
        return tag, start, hits, below | more, own

    def _last(self, tag: str) -> int:
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                return i
        return -1

    def handle_starttag(self, tag, attrs):
        start = self._offset()
        if tag in CLOSES_P and (i := self._last("p")) >= 0:
            self._close_to(i, start)
        if tag == "li" and (i := self._last("li")) >= 0:
            self._close_to(i, start)
        if tag in VOID:
            self._add(self._open(tag, attrs, start)[1:3], self.text.find(">", start) + 1 or len(self.text))
            return
        self.stack.append(self._open(tag, attrs, start))

    def handle_startendtag(self, tag, attrs):
        start = self._offset()
        self._add(self._open(tag, attrs, start)[1:3], self.text.find(">", start) + 1 or len(self.text))

    def handle_endtag(self, tag):
        i = self._last(tag)
        if i < 0:
            return
        pos = self._offset()
        end = self.text.find(">", pos) + 1 or len(self.text)
        self._close_to(i + 1, pos)
        self._add(self.stack.pop()[1:3], end)

    def elements(self):
        self.feed(self.text)
        self.close()
        self._close_to(0, len(self.text))
        return sorted(self.done, key=lambda e: (e[0], -e[1]))


def select_paths(html: str | None, selectors: list[str] | None) -> str | None:
    """Outer HTML of the selected elements joined by newlines; the whole
    input when no selector is given; null if one is not supported."""
    if html is None:
        return None
    if not selectors:
        return html
    machine = automaton(tuple(selectors))
    if machine is None:
        return None
    found = _Elements(html, machine).elements()
    kept: list[tuple[int, int]] = []
    for i in range(len(selectors)):
        for start, end, hits in found:
            if hits >> i & 1 and not any(s <= start and end <= e for s, e in kept):
                kept.append((start, end))
    return "\n".join(html[s:e] for s, e in kept)


def select_html(html: str | None, selectors: list[str] | None) -> str | None:
    """:func:`select_paths` with compounds only; null for anything else."""
    if html is not None and selectors and not all(is_compound(s) for s in selectors):
        return None
    return select_paths(html, selectors)


@F.pandas_udf(T.StringType())
def _select_udf(html: pd.Series, selectors: pd.Series) -> pd.Series:
    return pd.Series([select_paths(h, list(s) if s is not None else None) for h, s in zip(html, selectors)])


def select_elements(html, selectors) -> Column:
    """Column form: ``selectors`` is an ``array<string>`` column or a list."""
    h = F.col(html) if isinstance(html, str) else html
    s = F.array(*[F.lit(x) for x in selectors]) if isinstance(selectors, (list, tuple)) else (
        F.col(selectors) if isinstance(selectors, str) else selectors
    )
    return _select_udf(h, s)
