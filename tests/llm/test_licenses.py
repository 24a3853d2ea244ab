"""License scan."""

import re

from docweave.llm import licenses as L, queries as Q
from llm_fixtures import docs  # noqa: F401

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}


def brute(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORDS.findall(text)
    places = [(i, label) for label, p in PHRASES.items() for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


TEXTS = [None, "", "plain text", "CC-BY and cc by, cc\tby", "All rights reserved. all RIGHTS   reserved all rights", "GNU General Public License, version 3",
         "general public\nlicense", "Licensed under CC BY-NC 4.0.", "Released under the MIT License.", "é All rights reservedé all rights reserved",
         "word " * 5000 + "cc by", "by cc by cc by", "This work is licensed under the GNU General Public License, version 3."]


def test_base_columns_equal_brute_force(spark, docs, monkeypatch):
    monkeypatch.setattr(Q, "table", lambda *_: docs([*enumerate(TEXTS), (3, TEXTS[3])]))
    rows = Q.op2_licenses(spark, "").collect()
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(TEXTS[r.doc_id])
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
    labels = {r.doc_id: r.labels for r in rows}
    assert labels[7] == "cc-by,cc-by-nc-4.0" and labels[8] == "mit" and labels[12] == "gpl,gpl-3.0"


def test_mandatory_phrase_and_empty_table(docs):
    df = docs(["Released under the BSD License", "Released under the old MIT and other License"])
    assert [r.places for r in L.scan(df).collect()] == [[], []]
    assert L.scan(docs([])).count() == 0
