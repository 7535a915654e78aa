from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from bedside_spark.llm import spellings
from bedside_spark.llm.registry import QUERIES
from tests.llm import cases

SMALL = "/root/testdata/sf0.001"


def edits(word, letters):
    """All words one edit away."""
    cuts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    found = {a + b[1:] for a, b in cuts if b}
    found |= {a + c + b[1:] for a, b in cuts if b for c in letters}
    found |= {a + c + b for a, b in cuts for c in letters}
    return found - {word}


def brute(rows, least=2, ratio=10):
    counts = Counter()
    for i, text in rows:
        i = "" if i is None else i
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 7 and c >= least}
    letters = sorted(set("".join(n)))
    forms, near = {}, {}
    for word in n:
        near[word] = edits(word, letters) & n.keys()
        best = min(near[word], key=lambda w: (-n[w], w), default=None)
        forms[word] = best if best and n[best] >= ratio * n[word] else None

    def root(word):
        return root(forms[word]) if forms[word] else word

    return sorted((w, forms[w], root(w), n[w], len(near[w]), n.get(forms[w])) for w in n)


def listed(frame):
    return sorted(tuple(r) for r in frame.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    expected = brute(docs)
    assert listed(QUERIES["op12_spelling_variants"](spark, SMALL)) == expected
    assert any(r[1] for r in expected)


@pytest.mark.parametrize("longest", [2, 3, 4, 6])
def test_words_one_edit_apart_share_a_key(longest):
    rng = random.Random(longest)
    for _ in range(1500):
        letters = rng.choice(("ab", "abcdé", "a"))
        word = "".join(rng.choice(letters) for _ in range(rng.randrange(7, 16)))
        some = {word[i : i + q] for i in range(len(word)) for q in range(2, longest)}
        frequent = frozenset(g for g in some if rng.random() < 0.6)
        mine = set(spellings.keys(word, frequent, longest))
        for other in rng.sample(sorted(edits(word, letters + "z")), 3):
            if len(other) < spellings.MIN_LENGTH:
                continue
            theirs = set(spellings.keys(other, frequent, longest))
            met = [(key, role) for key, role in mine if (key, 0) in theirs or (role == 0 and (key, 1) in theirs)]
            assert met, (word, other)
            assert all(len(key.split(" ", 1)[1]) > 1 for key, _ in mine)


def made(spark, words):
    """One document per word and occurrence, with ids that delete nothing from any of them."""
    rows = []
    for word, n in words:
        i = 0
        for _ in range(n):
            i = next(j for j in range(i + 1, i + 9999) if zlib.crc32(f"{j}:{word}".encode()) % 31)
            rows.append((i, word))
    return spark.createDataFrame(rows, "doc_id long, text string"), rows


@pytest.mark.parametrize("crowded", [1, 5, 200])
def test_chains_ties_and_crowded_keys(spark, crowded):
    words = [
        ("abcdefgh", 400), ("abcdefg", 40), ("abcdefx", 4), ("abcdefgz", 400), ("zabcdefg", 2),
        ("aaaaaaaa", 2), ("aaaaaaa", 30), ("aaaaaaaaa", 2), ("élémentaire", 30), ("elémentaire", 3),
        *[(f"prefix{a}{b}suffix", 2) for a in "abcdefgh" for b in "abcdef"],
    ]
    docs, rows = made(spark, words)
    got = listed(spellings.variants(docs, crowded=crowded))
    assert got == brute(rows)
    told = {r[0]: r for r in got}
    assert told["abcdefx"][1:3] == ("abcdefg", "abcdefgh")
    assert told["prefixaasuffix"][4] == 12


def test_awkward_rows(spark):
    docs = cases.awkward(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert listed(spellings.variants(docs)) == brute(rows)
    assert spellings.variants(cases.empty(spark)).collect() == []


def test_long_texts_are_searched_in_parts(monkeypatch):
    monkeypatch.setattr(spellings, "_SEGMENT", 5)
    text = "one twothree. " * 50 + "x" * 40 + " é-é"
    found = [r for part in spellings.runs(text) for r in part]
    assert found == re.findall("[a-zÀ-ÿ]+", text)


def test_keys_that_share_a_number_change_nothing(spark, monkeypatch):
    words = [("abcdefgh", 40), ("abcdefg", 2), ("bcdefgh", 2), ("zzzzzzz", 3)]
    vocabulary = spark.createDataFrame(words, "word string, n long")
    monkeypatch.setattr(spellings, "_keyed", alike(spellings._keyed))
    for crowded in (2, 5000):
        got = {tuple(r) for r in spellings.near_pairs(vocabulary, crowded=crowded).collect()}
        assert got == {("abcdefg", "abcdefgh", 2, 40), ("abcdefgh", "bcdefgh", 40, 2)}


def alike(keyed):
    """Gives every key the same number."""
    import pyarrow as pa

    def changed(make):
        inner = keyed(make)

        def run(batches):
            for b in inner(batches):
                same = pa.array([7] * b.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays([same, b.column(1), b.column(2)], names=b.schema.names)

        return run

    return changed


def test_one_edit():
    rng = random.Random(3)
    words = ["".join(rng.choice("abé") for _ in range(rng.choice((3, 4, 5, 60, 61)))) for _ in range(150)]
    words += [w[:-1] for w in words] + [w[:2] + "a" + w[2:] for w in words]
    a, b = np.triu_indices(len(words), 1)
    got = spellings.one_edit(np.array(words, object), a, b)
    for i, j, near in zip(a.tolist(), b.tolist(), got.tolist()):
        if abs(len(words[i]) - len(words[j])) <= 1 and words[i] != words[j]:
            assert near == (words[j] in edits(words[i], "abé"))
        else:
            assert not near
