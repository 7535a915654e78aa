from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from bedside_spark.llm import arrays, substrings
from tests.llm import cases

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(texts, size):
    words = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i : i + size]) for w in words for i in range(len(w) - size + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i : i + size])] > 1:
                gone[i : i + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def mixed_texts():
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(12)]
    texts = [t for _, t in cases.TEXTS]
    for i in range(120):
        words = [rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(0, 60))]
        at = rng.randint(0, len(words))
        texts.append(" ".join(words[:at] + passage[: rng.randint(0, 12)] + words[at:]))
    return texts


@pytest.mark.parametrize("size,cells,chunk", [(5, None, 250_000), (5, 1 << 10, 40), (35, None, 250_000), (1, None, 90)])
def test_against_brute_force(spark, monkeypatch, size, cells, chunk):
    monkeypatch.setattr(substrings, "_CANDIDATES", chunk)
    texts = mixed_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = substrings.remove_repeated(docs, size, digests=True, cells=cells).collect()
    expected = sorted((i, *row) for i, row in enumerate(brute(texts, size)))
    assert sorted(map(tuple, got)) == expected


def test_awkward_rows(spark):
    docs = cases.awkward(spark)
    got = substrings.remove_repeated(docs, digests=True)
    expected = [(i, *r) for (i, _), r in zip(cases.TEXTS, brute([t for _, t in cases.TEXTS], 35))]
    assert cases.listed(got) == sorted(expected, key=repr)
    cut = substrings.cut_repeated(docs)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    unchanged = {r.doc_id: r.text for r in cut.collect()}
    assert unchanged[11] == dict(cases.TEXTS)[11] and unchanged[1] == ""
    assert substrings.remove_repeated(cases.empty(spark)).collect() == []


def test_sketch_never_underestimates():
    rng = np.random.default_rng(2)
    parts = [rng.integers(0, 3000, 500).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) for _ in range(4)]
    cells = 1 << 10
    once = {}
    for part in parts:
        for block, single, more in substrings._pieces(part, 0, cells):
            counts = once.setdefault(block, np.zeros(cells, np.int64))
            counts[substrings._unpacked(single)] += 1
            counts[substrings._unpacked(more)] += 2
    every = np.concatenate(parts)
    values, n = np.unique(every, return_counts=True)
    at = substrings._cells(values, 0, cells).astype(np.int64)
    assert (once[0][at][n > 1] >= 2).all()


def test_words_never_cross_documents():
    body = [b"ab", b"cd  ef", b"", b" g"]
    offsets = np.r_[0, np.cumsum([len(b) for b in body])]
    words = arrays.words_of(np.frombuffer(b"".join(body), np.uint8), offsets, arrays.NOT_BLANK)
    found = [words.data[a:b].tobytes() for a, b in zip(words.starts, words.ends)]
    assert found == [b"ab", b"cd", b"ef", b"g"] and words.counts.tolist() == [1, 2, 0, 1]
    again = arrays.words_of(np.frombuffer(b"g ab", np.uint8), np.array([0, 4]), arrays.NOT_BLANK)
    assert again.hashes()[1] == words.hashes()[0] and again.hashes()[0] == words.hashes()[3]
