from __future__ import annotations

import re
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
import verify
from bedside_spark.llm import quality
from tests.llm import cases

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen = Counter(zip(words, words[1:], words[2:]))
    covered = {
        i + k for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for k in range(3)
    }
    lines = [line for line in text.split("\n") if WORD.search(line)]
    counts = (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)), len(covered),
    )
    return *counts, len(words) < 50 or 100 * len(covered) > 50 * len(words)


def test_awkward_rows(spark):
    got = quality.quality_rules(cases.awkward(spark), "doc_id").collect()
    assert sorted((tuple(r[:7]) for r in got), key=repr) == sorted(
        ((i, *brute(t)) for i, t in cases.TEXTS), key=repr
    )
    assert quality.quality_rules(cases.empty(spark), "doc_id").collect() == []


def test_divergence(spark):
    from math import log2, sqrt

    from pyspark.sql import functions as F

    reference = [0.5, 0.25, 0.25]
    rows = [([2, 1, 1], 4), ([4, 0, 0], 4)]
    frame = spark.createDataFrame(rows, "counts array<int>, total int")
    got = frame.select(quality.divergence(F.col("counts"), F.col("total"), reference)).collect()
    p = [1.0, 0.0, 0.0]
    parts = [
        ((a * log2(2 * a / (a + b)) if a else 0) + b * log2(2 * b / (a + b))) / 2
        for a, b in zip(p, reference)
    ]
    assert got[0][0] == pytest.approx(0, abs=1e-7) and got[1][0] == pytest.approx(sqrt(sum(parts)))


def test_prose_stays_and_junk_goes(spark):
    prose = cases.PROSE
    junk = " ".join(f"w{i:x}### x{i}$$$ the%%%" for i in range(100))
    docs = spark.createDataFrame([(1, prose), (2, junk), (3, "short")], "doc_id long, text string")
    assert [r.doc_id for r in quality.drop_rejected(docs).collect()] == [1]


def test_against_duckdb(spark, tmp_path):
    cases.awkward(spark).repartition(2).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    got = quality.op4_quality_rules(spark, str(tmp_path)).toPandas()
    expected = con.execute(quality.oracle_sql()).df()
    for frame in (got, expected):  # pandas has no integer null
        frame["doc_id"] = frame["doc_id"].fillna(-1).astype("int64")
    assert verify.difference(got, expected) is None


def test_registered_text(spark):
    con = verify.connect("/root/testdata/sf0.001")
    got = contract.queries()["op4_quality_rules"](spark, "/root/testdata/sf0.001").toPandas()
    assert verify.difference(got, con.execute(contract.oracle_sql()["op4_quality_rules"]).df()) is None


def test_no_python_and_no_shuffle(spark):
    plan = quality.op4_quality_rules(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)


def test_a_filter_on_the_verdict_repeats_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    judged = quality.quality_rules(docs, "doc_id")
    plan = judged.where("kept")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("xxhash64") <= 2 * judged._jdf.queryExecution().optimizedPlan().toString().count("xxhash64")
    kept = {r.doc_id for r in judged.where("kept").collect()}
    assert kept == {r.doc_id for r in judged.collect() if r.kept}


REAL = {
    "en": "It was the best of times and it was the worst of times, and in the end all that we had was what "
    "is left to us by those who came before. The people of the town went on with their work as if it were "
    "a day like any other, and at the end of it they sat on the steps of the old house to talk of this and that.",
    "de": "Es war einmal ein Mann, der in der Stadt lebte und auf dem Markt die Waren von den Bauern für sich und "
    "das Haus kaufte. Er ist nicht weit gereist, und im Sommer ging er mit dem Hund an den Fluss, als ob die Zeit "
    "dort eine andere sei. Von der Brücke sah er auf das Wasser und die Boote, und das war ihm genug für den Tag.",
    "fr": "La maison est dans la rue qui va de la place à la gare, et les gens du quartier y passent pour aller au "
    "marché. Un homme que je connais vend des fruits sur le trottoir, et il parle de la pluie et du beau temps avec "
    "une voix qui est plus douce que le vent. Les enfants jouent dans la cour, pas loin des arbres en fleurs.",
    "es": "En un lugar de la costa vive una mujer que va al mercado por la mañana con su hijo. No se sabe de los años "
    "que lleva en el pueblo, y es que la gente no pregunta por las cosas del pasado. Los barcos salen del puerto a la "
    "hora de siempre, y el mar, con su ruido, es para ella la compañía que un día le dio a su vida un sentido.",
}


def test_invented_words_go_and_prose_of_four_languages_stays(spark):
    import random

    rng = random.Random(7)

    def invented(n):
        return " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(2, 9))) for _ in range(n))

    junk = [(i, invented(n)) for i, n in enumerate((60, 200, 2_000, 20_000))]
    prose = [(100 + i, text) for i, text in enumerate(REAL.values())]
    prose += [(200 + i, " ".join(f"{text} ({k})" for k in range(1))) for i, text in enumerate(REAL.values())]
    got = {r.doc_id: r for r in quality.quality_rules(
        spark.createDataFrame(junk + prose, "doc_id long, text string"), "doc_id").collect()}
    assert all(r.n_words >= 50 for r in got.values())
    assert all(not got[i].kept and got[i].word_distance > quality.MAX_WORD_DISTANCE for i, _ in junk)
    assert all(got[i].kept for i, _ in prose), {i: got[i] for i, _ in prose if not got[i].kept}


def test_labelled_documents(spark):
    """The rules reject nearly all documents marked bad and keep nearly all marked good."""
    folder = "/root/testdata/sf0.1"
    judged = quality.quality_rules(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id")
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("quality is not null")
    rows = judged.join(labels, "doc_id").where("n_words >= 50 and not base_failed")
    told = {(r.quality, r.kept): r["count"] for r in rows.groupBy("quality", "kept").count().collect()}
    assert told[0, False] > 0.95 * (told[0, False] + told.get((0, True), 0))
    assert told[1, True] > 0.99 * (told[1, True] + told.get((1, False), 0))
