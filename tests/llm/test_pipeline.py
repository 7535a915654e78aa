from __future__ import annotations

import hashlib

import sentencepiece
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from bedside_spark.llm import leaks, pieces, quality
from tests.llm import cases
from tests.llm.test_simhash import brute_fingerprint, brute_roots, signed
from tests.llm.test_substrings import brute as brute_windows

SMALL = "/root/testdata/sf0.001"


def run_stage(spark, number, docs, folder):
    frame = corpus_pipeline.STAGES[number][1](spark, docs, SMALL)
    path = f"{folder}/{number}"
    frame.write.parquet(path)
    return spark.read.parquet(path)


def test_every_stage_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("words", F.lit("extra"))
    rows = {r.doc_id: r for r in docs.collect()}

    kept = run_stage(spark, 0, docs, tmp_path)
    assert kept.columns == docs.columns
    good = {r.doc_id for r in quality.quality_rules(docs, "doc_id").where("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == good

    single = run_stage(spark, 1, kept, tmp_path)
    fps = {i: signed(brute_fingerprint(rows[i].text)) for i in good}
    roots, first = brute_roots(set(fps.values())), {}
    for i, fp in fps.items():
        first[roots[fp]] = min(i, first.get(roots[fp], i))
    assert sorted(r.doc_id for r in single.collect()) == sorted(first.values())

    cut = run_stage(spark, 2, single, tmp_path)
    ids = sorted(first.values())
    expected = dict(zip(ids, brute_windows([rows[i].text for i in ids], 35)))
    texts = {r.doc_id: r.text for r in cut.collect()}
    for i in ids:
        joined = " ".join(texts[i].split(" ")) if expected[i][1] else " ".join(rows[i].text.split())
        assert hashlib.sha256(joined.encode()).hexdigest() == expected[i][2]
        assert expected[i][1] or texts[i] == rows[i].text

    clean = run_stage(spark, 3, cut, tmp_path)
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    left = {r.doc_id for r in clean.collect()}
    assert not {i for i in left for item in items if item in texts[i]}
    found = leaks.leaks(cut, spark.read.parquet(f"{SMALL}/benchmark.parquet")).collect()
    assert left == set(texts) - {r.doc_id for r in found}

    library = sentencepiece.SentencePieceProcessor(model_proto=pieces.read_model())
    coded = run_stage(spark, 4, clean, tmp_path).collect()
    assert {r.doc_id: list(r.ids) for r in coded} == {i: library.encode(texts[i]) for i in left}


def test_run_gives_the_last_stage(spark):
    got = contract.queries()["pipeline"](spark, SMALL)
    assert 0 < got.count() <= 200 and got.columns[:2] == ["doc_id", "n_tokens"]


def test_awkward_and_empty_tables(spark, tmp_path):
    for name, docs in (("awkward", cases.awkward(spark)), ("empty", cases.empty(spark))):
        for number in range(5):
            out = run_stage(spark, number, docs, tmp_path / name)
            assert out.columns == docs.columns or number == 4
            assert name == "awkward" or out.count() == 0
