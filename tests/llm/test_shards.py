from __future__ import annotations

import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from bedside_spark.llm import shards
from tests.llm import cases


@pytest.mark.parametrize("n", [1, 2, 3, 5, 10, 97, 1000, 1023])
def test_permutation(spark, n):
    got = [r.p for r in spark.range(n).select(shards.permuted(F.col("id"), n).alias("p")).collect()]
    assert sorted(got) == list(range(n))
    other = [r.p for r in spark.range(n).select(shards.permuted(F.col("id"), n, 5).alias("p")).collect()]
    assert sorted(other) == list(range(n)) and (n < 10 or other != got)


def laws_hold(rows, count):
    sizes = Counter(r.shard for r in rows)
    assert all(0 <= s < count for s in sizes)
    assert max(sizes.values()) - min(sizes[s] for s in range(count)) <= 1
    for shard in sizes:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sizes[shard]))


def test_awkward_rows(spark):
    rows = shards.shards(cases.awkward(spark), 5).collect()
    laws_hold(rows, 5)
    expected = sorted(
        ((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in cases.TEXTS),
        key=repr,
    )
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in rows), key=repr) == expected
    assert shards.shards(cases.empty(spark)).collect() == []


def test_many_copies_are_written_in_parts(spark, monkeypatch):
    monkeypatch.setattr(shards, "COPIES", 7)
    docs = spark.range(100).select(F.lit(1).cast("long").alias("doc_id"), F.lit("x").alias("text"))
    rows = shards.shards(docs.unionByName(docs.withColumn("doc_id", F.lit(None).cast("long"))), 6).collect()
    assert len(rows) == 200
    laws_hold(rows, 6)


def test_same_places_however_the_rows_lie(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    once, again = (cases.listed(shards.shards(docs.repartition(n))) for n in (2, 7))
    assert once == again


def test_registered_query(spark):
    frame = shards.op6_sharding(spark, "/root/testdata/sf0.01")
    laws_hold(frame.collect(), 40)
    assert not re.search("Python|ArrowEval|Pandas", frame._jdf.queryExecution().toString())
