from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from bedside_spark.llm import sequences
from bedside_spark.llm.registry import QUERIES
from tests.llm import cases

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_buffer(sequences.read_tokenizer())


def brute(library, rows):
    """Documents in order of id: start, number of ids and their crc32."""
    out, start = [], 0
    for i, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_against_brute_force(spark, library):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    got = QUERIES["op13_arrow_sequences"](spark, SMALL).collect()
    assert sorted(tuple(r) for r in got) == brute(library, rows)


def test_pieces_give_the_ids_of_the_whole_text(library):
    rng = np.random.default_rng(5)
    letters = list("ab'sé漢 \xa0 \n\t.,1  ") + ["<|endoftext|>", " the", "'re", " x", "Z", ";", "!", "\r", "d"]
    texts = ["".join(rng.choice(letters, rng.integers(0, 60))) for _ in range(3000)]
    bodies = [t.encode() for t in texts]
    encoder = sequences.Encoder(sequences.read_tokenizer())
    data = np.frombuffer(b"".join(bodies), np.uint8)
    offsets = np.cumsum([0, *map(len, bodies)])
    for step in (1, 50, 3000):
        got, sizes = [], []
        for a in range(0, len(texts), step):
            ids, counts = encoder.encode(data, offsets[a : a + step + 1])
            got.append(ids)
            sizes.append(counts)
        flat, ends = np.concatenate(got), np.cumsum(np.concatenate(sizes))
        for text, part in zip(texts, np.split(flat, ends[:-1])):
            assert part.tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_files_give_random_access_without_copies(spark, library, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    index = sequences.write_sequences(docs, str(tmp_path), length=32, end_id=7)
    shards = {r.shard for r in index.select("shard").distinct().collect()}
    texts = dict(docs.select("doc_id", "text").collect())
    for shard in sorted(shards)[:5]:
        rows = index.where(F.col("shard") == shard).orderBy("start").collect()
        stream = [i for r in rows for i in [*library.encode(texts[r.doc_id] or "").ids, 7]]
        file = sequences.SequenceFile(str(tmp_path), shard)
        assert len(file) == -(-len(stream) // 32)
        for i in range(len(file)):
            ids, mask = file.sequence(i)
            own = stream[32 * i : 32 * i + 32]
            assert ids.dtype == np.uint16 and not ids.flags.owndata
            assert ids[mask].tolist() == own and mask.tolist() == [True] * len(own) + [False] * (32 - len(own))
        for start, n in ((0, 1), (5, 100), (len(stream) - 3, 3)):
            assert np.concatenate(list(file.span(start, n))).tolist() == stream[start : start + n]
        path = sequences.shard_path(str(tmp_path), shard)
        assert pa.types.is_fixed_size_list(pa.ipc.open_file(path).schema.field("ids").type)
        file.close()
    left = list((tmp_path / "sequences").iterdir())
    assert {p.suffix for p in left} == {".arrow"} and len(left) == len(shards)


@pytest.mark.parametrize("part", [64, 4 << 20])
def test_awkward_rows(spark, library, tmp_path, part):
    docs = cases.awkward(spark)
    sequences.write_sequences(docs, str(tmp_path), length=16, part_bytes=part)
    got = sequences.read_documents(spark, str(tmp_path)).collect()
    expected = brute(library, [(r.doc_id, r.text) for r in docs.collect()])
    assert sorted((str(r[0]), r[2], r[3]) for r in got) == sorted((str(r[0]), r[2], r[3]) for r in expected)
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.start for r in ordered] == np.cumsum([0, *(r.n_tokens for r in ordered)])[:-1].tolist()
    ids = [r.doc_id for r in ordered]
    assert ids == sorted(ids, key=lambda i: -1 if i is None else i)


def test_empty_table(spark, tmp_path):
    index = sequences.write_sequences(cases.empty(spark), str(tmp_path))
    assert index.count() == 0
    assert sequences.read_documents(spark, str(tmp_path)).collect() == []
