from __future__ import annotations

import random

import pytest

from bedside_spark.llm import tokencounts
from tests.llm import cases


@pytest.fixture(scope="module")
def counter():
    return tokencounts.Counter(tokencounts.read_ranks(), tokencounts.public_pattern())


def brute(counter, text):
    return len(counter.encoding.encode_ordinary(text))


@pytest.mark.parametrize("full", [3, 256])
def test_edits_count_as_a_full_count(counter, monkeypatch, full):
    monkeypatch.setattr(tokencounts, "FULL", full)
    monkeypatch.setattr(tokencounts, "LEAF", 2 if full == 3 else 64)
    rng, letters = random.Random(full), " \n\tab's1é漢  .,'re"
    for _ in range(400):
        text = "".join(rng.choice(letters) for _ in range(rng.choice((0, 1, 5, 40, 600))))
        tree = tokencounts.Tree(counter, text)
        assert tree.total == brute(counter, text)
        for _ in range(5):
            start, length = rng.randrange(len(text) + 3), rng.choice((0, 1, 3, 30))
            new = "".join(rng.choice(letters) for _ in range(rng.choice((0, 1, 2, 20, 300))))
            at = min(start, len(text))
            text = text[:at] + new + text[at + length :]
            tree.edit(start, length, new)
            assert tree.text == text and tree.total == brute(counter, text)


def test_an_edit_encodes_little(counter):
    tree = tokencounts.Tree(counter, cases.LONG)
    tree.edit(len(cases.LONG) // 2, 3, "xyz")
    assert tree.encoded < 10


def test_awkward_rows(spark, counter):
    docs = tokencounts.with_edits(cases.awkward(spark))
    edited = {}
    for r in docs.collect():
        text = r.text or ""
        for e in r.edits:
            text = text[: e.start] + (e.replacement or "") + text[e.start + e.length :]
        edited.setdefault(r.doc_id, []).append((brute(counter, r.text or ""), 3, brute(counter, text)))
    got = {}
    for r in tokencounts.count_tokens(docs).collect():
        got.setdefault(r.doc_id, []).append((r.n_tokens, r.n_edits, r.n_tokens_edited))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in edited.items()}
    assert tokencounts.count_tokens(tokencounts.with_edits(cases.empty(spark))).collect() == []


def test_odd_edits(spark, counter):
    rows = [
        (1, "abc def", [(-5, -1, None), (99, 5, " tail"), (None, None, "x")]),
        (2, "abc", None),
        (3, None, [(0, 0, "new text")]),
        (4, "abc", [(0, 99, None)]),
    ]
    schema = "doc_id long, text string, edits array<struct<start:int,length:int,replacement:string>>"
    got = {r.doc_id: r for r in tokencounts.count_tokens(spark.createDataFrame(rows, schema)).collect()}
    assert got[1].n_tokens_edited == brute(counter, "xabc def tail")
    assert (got[2].n_edits, got[2].n_tokens_edited) == (0, brute(counter, "abc"))
    assert (got[3].n_tokens, got[3].n_tokens_edited) == (0, brute(counter, "new text"))
    assert got[4].n_tokens_edited == 0
