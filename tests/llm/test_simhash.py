from __future__ import annotations

import random
import re

import pytest
import xxhash

from bedside_spark.llm import components, simhash
from tests.llm import cases

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: chr(c + 32) for c in range(65, 91)}


def brute_fingerprint(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def brute_roots(values):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    listed = sorted(values)
    for i, a in enumerate(listed):
        for b in listed[i + 1 :]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


@pytest.mark.parametrize("text", [t for _, t in cases.TEXTS])
def test_fingerprint(text, monkeypatch):
    monkeypatch.setattr(simhash, "_CHUNK", 7)
    got = simhash.fingerprint(None if text is None else text.encode())
    assert got == signed(brute_fingerprint(text))


def near_values():
    rng = random.Random(9)
    base = [rng.getrandbits(64) for _ in range(40)]
    values = set(base)
    for v in base[:6]:  # crowded neighbourhoods
        for _ in range(60):
            w = v
            for _ in range(rng.randint(1, 6)):
                w ^= 1 << rng.randrange(64)
            values.add(w)
    return {signed(v) for v in values}


@pytest.mark.parametrize("bucket", [2, 64])
def test_links_and_components(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    values = near_values()
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    found = {tuple(r) for r in simhash.links(fps).distinct().collect()}
    expected = {
        (a, b) for a in values for b in values if a > b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3
    }
    assert found == expected
    roots = brute_roots(values)
    got = {r.u: r.v for r in components.stars(simhash.links(fps)).collect()}
    assert got == {v: r for v, r in roots.items() if r != v}


def test_a_long_chain_is_one_component(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(300)], "u long, v long")
    assert {r.v for r in components.stars(links).collect()} == {0}
    assert components.stars(links.limit(0)).collect() == []


def test_awkward_rows(spark):
    docs = cases.awkward(spark)
    got = simhash.near_duplicates(docs).collect()
    values = {signed(brute_fingerprint(t)) for _, t in cases.TEXTS}
    roots = brute_roots(values)
    first = {}
    for i, t in cases.TEXTS:
        root = roots[signed(brute_fingerprint(t))]
        if i is not None:
            first[root] = min(i, first.get(root, i))
    expected = [
        (i, signed(brute_fingerprint(t)), first.get(roots[signed(brute_fingerprint(t))]))
        for i, t in cases.TEXTS
    ]
    assert sorted(((r.doc_id, r.fp, r.component_id) for r in got), key=repr) == sorted(expected, key=repr)
    stay = simhash.one_per_group(docs)
    assert stay.columns == docs.columns
    kept = sorted((r.doc_id for r in stay.collect()), key=repr)
    assert kept == sorted(set(first.values()), key=repr)
    assert simhash.one_per_group(cases.empty(spark)).collect() == []
    assert simhash.near_duplicates(cases.empty(spark)).collect() == []


def test_groups_without_ids_and_repeated_rows_keep_one(spark):
    rows = [(None, "a b c d"), (None, "a b c d"), (None, "z y x w"), (5, "q r s t"), (5, "q r s t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert cases.listed(simhash.one_per_group(docs)) == sorted(set(rows), key=repr)
