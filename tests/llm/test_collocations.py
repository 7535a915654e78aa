from __future__ import annotations

import random
import re
from collections import Counter
from types import SimpleNamespace

import pyarrow as pa
import pytest

from bedside_spark.llm import collocations
from bedside_spark.llm.registry import QUERIES
from tests.llm import cases

SMALL = "/root/testdata/sf0.001"
COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def brute(rows, threshold=30, top=2000):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                own = f.setdefault((lang, k), Counter())
                own.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang in n:
        at = {k: f.get((lang, k), {}) for k in range(1, 5)}
        found = []
        for k in (2, 3, 4):
            for p, a in at[k].items():
                if a < threshold:
                    continue
                cuts = [(2_000_000 * a // (at[i][p[:i]] + at[k - i][p[i:]]), i) for i in range(1, k)]
                score, i = min(cuts)
                longer = any(
                    100 * b >= 80 * a
                    for q in range(k + 1, 5)
                    for other, b in inside.get((lang, q, p), ())
                ) if (inside := index(at, lang, threshold)) else False
                if not longer:
                    found.append((-score, -a, " ".join(p).encode(), at[i][p[:i]], at[k - i][p[i:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


_INDEX: dict = {}


def index(at, lang, threshold):
    """Longer candidates by the phrases inside them."""
    key = (id(at), lang)
    if _INDEX.get("key") != key:
        found: dict = {}
        for q in (3, 4):
            for other, b in at[q].items():
                if b >= threshold:
                    for k in range(2, q):
                        for i in range(q - k + 1):
                            found.setdefault((lang, q, other[i : i + k]), []).append((other, b))
        _INDEX.update(key=key, found=found)
    return _INDEX["found"]


def listed(frame):
    return sorted(tuple(r) for r in frame.select(*COLUMNS).collect())


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("lang", "text").collect()
    expected = brute(docs)
    assert listed(QUERIES["op11_phrase_collocations"](spark, SMALL)) == expected and expected


def noise(seed, n):
    """Texts of few words, so phrases of all lengths reach the threshold at different steps."""
    rng = random.Random(seed)
    marks = ["", "", "", "", ".", ",", "\n", " ;", "\t", "!?", "\r\n"]
    words = ["a", "B", "b", "la", "Überall", "x-y", "\x00", "漢字", "'s"]
    weights = [30, 10, 10, 9, 5, 3, 2, 1, 1]
    rows = []
    for i in range(n):
        size = rng.choice((0, 1, 3, 30, 60))
        text = " ".join(w + rng.choice(marks) for w in rng.choices(words, weights, k=size))
        rows.append((i, rng.choice(["en", "en", None, "und", "de", ""]), text))
    return rows


@pytest.mark.parametrize(("shards", "part", "threshold"), [(1, 4 << 20, 5), (3, 16, 9), (5, 4 << 20, 3)])
def test_scans_interleave_lengths_without_losing_a_phrase(spark, shards, part, threshold):
    rows = noise(shards, 120)
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3)
    got = collocations.collocations(docs, 25, threshold, shards, part_bytes=part)
    assert listed(got) == brute([(lang, text) for _, lang, text in rows], threshold, 25)


def test_a_crowded_sketch_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(collocations, "cells_for", lambda words, threshold: 4)
    rows = noise(9, 60)
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    got = collocations.collocations(docs, 2000, 4, 2)
    assert listed(got) == brute([(lang, text) for _, lang, text in rows], 4)


def test_ties_redundant_phrases_and_large_numbers(spark):
    text = "alpha beta gamma delta. " * 40 + "alpha beta. " * 9 + "one two, " * 40 + "two one; " * 40
    docs = spark.createDataFrame([(1, "en", text)], "doc_id long, lang string, text string")
    got = {r.phrase: r for r in collocations.collocations(docs).collect()}
    assert set(got) == {"alpha beta gamma delta", "one two", "two one"}
    assert [got[p].rank for p in ("alpha beta gamma delta", "one two", "two one")] == [1, 2, 3]
    big = 3 * 10**15
    counts = spark.createDataFrame(
        [("en", 1, "a", 2 * big), ("en", 1, "b", big), ("en", 2, "a b", big - 1)],
        "lang string, k int, phrase string, n long",
    )
    row = collocations.without_contained(collocations.scored(counts)).first()
    assert row.score == 2_000_000 * (big - 1) // (3 * big)


def test_awkward_rows(spark):
    docs = cases.awkward(spark)
    expected = brute([(r.lang, r.text) for r in docs.collect()])
    assert listed(collocations.collocations(docs)) == expected and expected
    assert collocations.collocations(cases.empty(spark)).collect() == []


def test_a_step_is_one_job_however_many_partitions_a_shuffle_has(spark):
    rows = noise(4, 120)
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3)
    settings = {"spark.sql.shuffle.partitions": "48", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in settings}
    jobs = spark.sparkContext._jsc.sc().dagScheduler()
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        before = jobs.numTotalJobs()
        frequent, total = collocations.frequencies(docs, 4, shards=2)
        # Two shards: eight steps at most, each with a broadcast or a stage of its own.
        assert jobs.numTotalJobs() - before < 48
        assert frequent.count() and {r.lang for r in total.collect()} == {"en", "und", "de", ""}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def last_scan(rows, buckets, threshold, most=1 << 12):
    """What tasks of a batch each send of phrases of all counters, and the sums of it."""
    sketch = collocations.Sketch(1 << 8, threshold, 4)
    for counts in sketch.counts.values():
        counts[:] = threshold
    count = collocations._count_full(SimpleNamespace(value=(sketch.cells, sketch.full())), most, buckets)
    sent = []
    for i in range(3):
        own = rows[i::3]
        columns = [pa.array([lang for lang, _ in own]), pa.array([text.encode() for _, text in own], pa.binary())]
        batch = pa.RecordBatch.from_arrays(columns, names=["lang", "body"])
        sent.append([*count(iter([batch]))])
    flat = [b for own in sent for b in own]
    sums = [r for b in collocations._sum_sent(threshold)(iter(flat)) for r in b.to_pylist()]
    return sent, sorted((r["lang"], r["k"], r["phrase"], r["n"]) for r in sums)


def exact(rows, threshold):
    f, n = Counter(), Counter()
    for lang, text in rows:
        words = text.split(" ")
        n[lang, 0, ""] += len(words)
        f.update((lang, k, " ".join(words[i : i + k])) for k in range(1, 5) for i in range(len(words) - k + 1))
    return sorted([(*p, c) for p, c in f.items() if c >= threshold] + [(*p, c) for p, c in n.items()]), f


def test_the_last_scan_sends_a_row_for_each_task_and_bucket():
    rng = random.Random(2)
    words = [rng.choice(("tion", "er", "the", "\x00", "ß")) * rng.randint(1, 3) + str(i) for i in range(30)]
    rows = [(rng.choice("ab"), " ".join(rng.choices(words, k=200))) for _ in range(150)]
    expected, phrases = exact(rows, 9)
    sent, got = last_scan(rows, 5, 9)
    assert got == expected and len(expected) > 1000
    assert all(len(own) <= 5 and sum(b.num_rows for b in own) <= 5 for own in sent)
    packed = sum(len(v) for own in sent for b in own for c in b.columns[2:] for v in c.to_pylist())
    assert packed < 0.5 * sum(len(p.encode()) for _, _, p in phrases)


def test_sums_of_parts_change_nothing(monkeypatch):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), " ".join(rng.choices("vwxyz", k=rng.randint(1, 90)))) for _ in range(60)]
    monkeypatch.setattr(collocations, "_HELD", 40)
    sent, got = last_scan(rows, 3, 4, most=64)
    assert got == exact(rows, 4)[0] and max(len(own) for own in sent) > 3
    monkeypatch.setattr(collocations, "_HELD_BYTES", 100)
    assert last_scan(rows, 3, 4, most=64)[1] == got
