"""Packing: exact round trip, ids of the tokenizer file, numbering."""

import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from docweave.llm import packing as P
from docweave.sources.tables import table
from llm_fixtures import docs  # noqa: F401

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(PATH)


def ids_of(whole, text):
    return whole.encode(text or "", add_special_tokens=False).ids + [0]


def check(rows, got, whole, capacity):
    """Every document comes back from its pieces; sequences are whole powers of two, numbered by bucket."""
    by_doc, want = defaultdict(list), defaultdict(list)
    for i, text in rows:
        want[i].append(ids_of(whole, text))
    for r in got:
        ids = np.frombuffer(r.tokens, "<u4").tolist()
        assert len(ids) == r.length and r.offset == 0 and r.length <= capacity and r.length & (r.length - 1) == 0
        by_doc[r.doc_id].append((r.start, r.length, ids, r.doc_tokens))
    assert by_doc.keys() == want.keys()
    for i, texts in want.items():
        if len(texts) == 1:
            pieces = sorted(by_doc[i])
            assert [x for p in pieces for x in p[2]] == texts[0]
            assert [p[0] for p in pieces] == np.cumsum([0] + [p[1] for p in pieces])[:-1].tolist()
            rest = [p[1] for p in pieces if p[1] < capacity]
            assert rest == sorted(set(rest), reverse=True) and {p[3] for p in pieces} == {len(texts[0])}
        else:
            flat = sorted((n, tuple(t[at:at + n])) for t in texts for at, n in zip(np.cumsum([0] + P.binary_lengths(len(t), capacity)), P.binary_lengths(len(t), capacity)))
            assert sorted((p[1], tuple(p[2])) for p in by_doc[i]) == flat
    numbers = sorted((r.sequence_id, r.length) for r in got)
    assert [n for n, _ in numbers] == list(range(len(got)))
    assert [n for _, n in numbers] == sorted((r.length for r in got), reverse=True)


@pytest.mark.parametrize("capacity", [1024, 16, 1])
def test_round_trip_and_edge_cases(spark, docs, whole, capacity):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(["alpha", "Größe", "日本語", "don't", "1234", "  ", "\n"], k=rng.randint(0, 400)))) for i in range(40)]
    rows += [(100, None), (101, ""), (102, "a<|endoftext|>b"), (103, " " * 300_000 + "x"), (104, "a" * 200_000), (105, "word " * 60_000),
             (106, "same"), (106, "same"), (106, "other text"), (None, "no id"), (2**60 + 1, "large id")]
    check(rows, P.pack(docs(rows), PATH, capacity).collect(), whole, capacity)


def test_given_documents(spark, whole):
    rows = [tuple(r) for r in table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()]
    check(rows, P.pack(table(spark, "/root/testdata/sf0.001", "documents"), PATH).collect(), whole, 1024)


def test_empty_table(spark, docs):
    assert P.pack(docs(["x"]).limit(0), PATH).count() == 0


def test_capacity_must_be_a_power_of_two(docs):
    with pytest.raises(ValueError):
        P.pack(docs(["x"]), PATH, 1000)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_ids_of_any_text(text):
    assert _ids(text) == _file.encode(text, add_special_tokens=False).ids


_ids, _file = P.encoder(PATH), Tokenizer.from_file(PATH)


def test_binary_lengths():
    assert P.binary_lengths(2048 + 5, 1024) == [1024, 1024, 4, 1]
    assert all(sum(P.binary_lengths(n, 64)) == n for n in range(300))
