from __future__ import annotations

import zlib

import numpy as np
import pytest

from bedside_spark.llm import convnet, toxicity
from tests.llm import cases

SMALL = "/root/testdata/sf0.01"


def labels_of(spark, column):
    return {r[0]: r[1] for r in spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", column).collect()}


def accuracy(rows, labels):
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert len(held) > 40
    return np.mean([p == y for p, y in held]), max(np.mean([y for _, y in held]), np.mean([1 - y for _, y in held]))


def test_toxicity_held_out_accuracy(spark):
    rows = toxicity.op2_toxicity(spark, SMALL).collect()
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    got, usual = accuracy(rows, labels_of(spark, "toxic"))
    assert got >= usual and got > 0.93


def test_quality_held_out_accuracy(spark):
    rows = convnet.op9_quality_classifier(spark, SMALL).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    got, usual = accuracy(rows, labels_of(spark, "quality"))
    assert got >= usual and got > 0.93


def test_ftrl_finds_the_telling_coordinate():
    rng = np.random.default_rng(1)
    rows = []
    for i in range(600):
        label = i % 3 == 0
        places = rng.choice(np.arange(100, 400), 30, replace=False)
        rows.append((np.unique(np.r_[places, 7] if label else places), int(label)))
    used, weights, _ = toxicity.train(rows)
    assert used[np.argmax(weights)] == 7 and len(used) < 300


def test_features_match_a_plain_count():
    body = b"a b A b"
    data, offsets = np.frombuffer(body, np.uint8), np.array([0, len(body)])
    owner, place = toxicity.features(data, offsets)
    # words a, b; pairs ab, ba; with one between aa, bb
    assert len(place) == 6 and set(owner) == {0}
    shouted = toxicity.features(np.frombuffer(b"A B a B", np.uint8), offsets)[1]
    assert (shouted == place).all()


def test_chunks_cover_the_whole_text():
    for n in (0, 1, 511, 512, 513, 1008, 1009, 5000):
        body = bytes(i % 251 for i in range(n))
        chunks = convnet.chunks_of(body)
        step = convnet.CHUNK - convnet.OVERLAP
        flat = np.concatenate([chunks[0], *(c[convnet.OVERLAP :] for c in chunks[1:])])
        assert flat[:n].tolist() == list(body) and (flat[n:] == 256).all()
        assert len(chunks) == 1 or (len(chunks) - 1) * step + convnet.OVERLAP < n


def test_gradients_match_differences():
    network = convnet.Network(3)
    network.p = {k: v.astype(np.float64) for k, v in network.p.items()}
    held = [convnet.chunks_of(bytes([i % 90 + 30 for i in range(n)])) for n in (40, 1300)]
    labels = np.array([1.0, 0.0])

    def loss():
        sizes = np.array([len(h) for h in held])
        pooled = network.pooled(np.concatenate(held))[0]
        p = network.combine(pooled, np.cumsum(sizes) - sizes)[2]
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    g = network.gradients(held, labels)
    for name, index in (("out", (2, 0)), ("hidden", (30, 1)), ("filters", (5, 3)), ("offset", (2,))):
        kept = network.p[name][index]
        network.p[name][index] = kept + 1e-5
        up = loss()
        network.p[name][index] = kept - 1e-5
        down = loss()
        network.p[name][index] = kept
        assert g[name][index] == pytest.approx((up - down) / 2e-5, rel=0.02, abs=1e-5)


@pytest.mark.parametrize("module", [toxicity, convnet])
def test_awkward_rows(spark, module):
    docs = cases.awkward(spark)
    labels = spark.createDataFrame(
        [(1, 1, 0), (2, 1, 0), (2, 0, 1), (9, 1, 0), (8, 0, 1), (None, 1, 1), (3, None, None)],
        "doc_id long, quality int, toxic int",
    )
    model = module.fit(docs, labels)
    rows = module.scores(docs, model).collect()
    assert len(rows) == len(cases.TEXTS) and all(0 <= r.score <= 1 for r in rows)
    assert module.scores(cases.empty(spark), model).collect() == []
    untrained = module.scores(docs, module.fit(docs, labels.limit(0))).collect()
    assert {r.score for r in untrained} == {0.5}
