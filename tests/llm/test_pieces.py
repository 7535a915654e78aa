from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from bedside_spark.llm import pieces
from tests.llm import cases

ALPHABET = " \n\ta▁bé𝄞漢字the<s>0x0A>  .ingtion"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_proto=pieces.read_model())


@pytest.fixture(scope="module")
def own():
    return pieces.Pieces(pieces.read_model())


def texts():
    rng = random.Random(5)
    return [
        "", " ", "a" * 500, " " * 1500 + "x", "\x00a", "abababab" * 40, "▁▁a  ▁", "﻿x",
        *("".join(rng.choice(ALPHABET) for _ in range(rng.randint(1, 80))) for _ in range(800)),
        *(t or "" for _, t in cases.TEXTS),
    ]


def test_same_ids_and_texts_as_the_library(own, library):
    given = texts()
    ids, counts, joined = own.encode(given)
    ends = np.r_[0, np.cumsum(counts)]
    decoded = own.decode(ids, counts)
    for i, text in enumerate(given):
        expected = library.encode(text)
        assert ids[ends[i] : ends[i + 1]].tolist() == expected
        assert joined[i] == ",".join(map(str, expected))
        assert decoded[i].decode() == library.decode(expected)


def test_decoding_any_ids(own, library):
    rng = random.Random(6)
    runs = [
        [rng.choice([rng.randrange(32000), rng.randrange(3, 259)]) for _ in range(rng.randint(0, 9))]
        for _ in range(800)
    ]
    got = own.decode(np.array(sum(runs, [])), np.array([len(r) for r in runs]))
    assert [g.decode() for g in got] == [library.decode(r) for r in runs]


def test_words_of_many_rounds_are_finished_the_same_way(library, monkeypatch):
    monkeypatch.setattr(pieces, "ROUNDS", 2)
    short = pieces.Pieces(pieces.read_model())
    for text in texts()[:120]:
        assert short.encode([text])[0].tolist() == library.encode(text)


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    short = pieces.Pieces(pieces.read_model())
    for text in texts()[-300:]:
        assert short.encode([text])[0].tolist() == library.encode(text)


def test_operators(spark, library):
    docs = cases.awkward(spark)
    got = pieces.encode(docs, outputs=(*pieces.DIGESTS, "ids", "decoded")).collect()
    expected = []
    for i, text in cases.TEXTS:
        ids = library.encode(text or "")
        expected.append((
            i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(library.decode(ids).encode()).hexdigest(), ids, library.decode(ids),
        ))
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
    back = pieces.decode(pieces.encode(docs))
    assert cases.listed(back) == sorted(((r[0], r[5]) for r in expected), key=repr)
    assert pieces.encode(cases.empty(spark)).collect() == []
