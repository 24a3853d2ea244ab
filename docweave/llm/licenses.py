"""License scan with a positional rare-token index.

Licence templates are short word sequences with mandatory key phrases.  The
index maps a word to its postings (template, position).  For a file the
licence words with the highest inverse document frequency are looked up (the
rarest words of each template, frequencies counted over the whole corpus);
each posting proposes a place of the template, and the places on which the
rare words agree are intersected with the postings of all its words by
relative position.  A template counts where every key phrase stands at the
place.  A phrase template is its own key phrase, so each of its places is
found and must match in full.

Edge cases: a null text is empty; an empty text has no words and the score 0;
repeated rows give repeated results; an empty table gives an empty result;
only the named columns are read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from docweave.llm.common import plain_words, texts, utf8

RARE_WORDS = 3
MIN_SCORE = 0.6


class Template(NamedTuple):
    label: str
    text: str
    keys: tuple[str, ...]
    phrase: bool = False  # base phrase: matches in full


# Phrases and labels of the scan, short licence notices.
TEMPLATES = [
    Template("cc-by", "cc by", ("cc by",), True),
    Template("gpl", "general public license", ("general public license",), True),
    Template("reserved", "all rights reserved", ("all rights reserved",), True),
    Template("mit", "Released under the MIT License", ("mit license",)),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
             ("permission is hereby granted free of charge",)),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license version 2 0",)),
    Template("gpl-3.0", "This work is licensed under the GNU General Public License, version 3",
             ("gnu general public license", "version 3")),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", ("cc by nc 4 0",)),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted",
             ("redistribution and use in source and binary forms",)),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
             ("mozilla public license v 2 0",)),
]


def _find(words: list[bytes], phrase: list[bytes], lo: int, hi: int) -> bool:
    """Does the phrase stand in ``words[lo:hi]``?"""
    n = len(phrase)
    return any(words[i:i + n] == phrase for i in range(max(0, lo), min(len(words), hi) - n + 1) if words[i] == phrase[0])


class RareTokenIndex:
    """Postings of the template words and the rare words of each template."""

    def __init__(self, templates: list[Template], idf: dict[bytes, float]):
        self.templates = templates
        self.words = [plain_words(utf8(t.text)) for t in templates]
        self.keys = [[plain_words(utf8(k)) for k in t.keys] for t in templates]
        self.idf = idf
        self.weight = [sum(idf[w] for w in ws) or 1.0 for ws in self.words]
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        for t, ws in enumerate(self.words):
            rare = sorted(set(ws), key=lambda w: (-idf[w], w))[:1 if templates[t].phrase else RARE_WORDS]
            for p, w in enumerate(ws):
                if w in rare:
                    self.postings.setdefault(w, []).append((t, p))

    def places(self, words: list[bytes]) -> Iterator[tuple[int, int, float]]:
        """(template, start, score) of every verified place."""
        votes = Counter()
        for i, w in enumerate(words):
            if w in self.postings:
                votes.update((t, i - p) for t, p in self.postings[w])
        for (t, start), n in sorted(votes.items()):
            own = self.words[t]
            if self.templates[t].phrase:
                if start >= 0 and words[start:start + len(own)] == own:
                    yield t, start, 1.0
                continue
            if n < min(2, len(own)):
                continue
            hit = sum(self.idf[w] for p, w in enumerate(own) if 0 <= start + p < len(words) and words[start + p] == w)
            score = min(1.0, hit / self.weight[t])
            if score >= MIN_SCORE and all(_find(words, k, start - 1, start + len(own) + 1) for k in self.keys[t]):
                yield t, start, score


def word_weights(df: DataFrame, templates: list[Template]) -> dict[bytes, float]:
    """Inverse document frequency of each template word over all texts."""
    vocabulary = frozenset(w for t in templates for w in plain_words(utf8(t.text)))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, n = Counter(), 0
        for f in frames:
            for text in f["text"]:
                seen.update(vocabulary.intersection(plain_words(utf8(text))))
            n += len(f)
        yield pd.DataFrame([(b"", n), *seen.items()], columns=["word", "n"])

    rows = df.select("text").mapInPandas(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()  # vocabulary size
    counts = {bytes(r["word"]): r["n"] for r in rows}
    n = counts.get(b"", 0)
    return {w: math.log((n + 1) / (counts.get(w, 0) + 1)) + 1e-3 for w in vocabulary}


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[Template] | None = None) -> DataFrame:
    """``(doc_id, n_words, score, places array<struct<label, phrase, start, stop, score>>)`` for each row."""
    docs, templates = texts(df, id_col, text_col), templates or TEMPLATES
    index = RareTokenIndex(templates, word_weights(docs, templates))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for doc_id, text in zip(f["doc_id"], f["text"]):
                words = plain_words(utf8(text))
                found = [{"label": templates[t].label, "phrase": templates[t].phrase, "start": s,
                          "stop": s + len(index.words[t]), "score": x} for t, s, x in index.places(words)]
                out.append((doc_id, len(words), max([0.0, *(p["score"] for p in found)]), found))
            yield pd.DataFrame(out, columns=["doc_id", "n_words", "score", "places"]).astype({"doc_id": "Int64"})

    return docs.mapInPandas(run, "doc_id long, n_words long, score double, "
                                 "places array<struct<label: string, phrase: boolean, start: long, stop: long, score: double>>")
