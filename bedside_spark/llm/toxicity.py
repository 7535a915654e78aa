"""Toxicity: FTRL-proximal logistic regression over hashed n-grams and skip-grams.

Features of a text are its distinct lower-cased words, pairs of neighbours and pairs with one
word between, hashed to ``2 ** BITS`` coordinates with value 1. Training reads the features of
at most ``TRAIN_ROWS`` labelled documents in the order of their ids' hashes; every coordinate
has its own rate, and L1 leaves few weights, which is what the scoring tasks get.

Defined results: a null or empty text has no features and the score of the intercept; without
labelled documents every score is 0.5 and the prediction 1; a null id is held out by the
remainder of the empty text; repeated rows give repeated results; only id, text and, for
training, ``labels`` are read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bedside_spark.llm.arrays import ALPHANUMERIC, LOWER, document_bytes, mixed, slices, words_of
from bedside_spark.llm.frames import remainder_of_id, table, text_bytes
from bedside_spark.llm.samples import labelled_ids

BITS = 18
TRAIN_ROWS = 12_000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 8.0, 0.1
FOLDS, HELD_OUT = 5, 0
_PAIR, _SKIP = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def features(data: np.ndarray, offsets: np.ndarray, used: np.ndarray | None = None):
    """(document, coordinate) of the distinct features of a slice, sorted by document.

    With ``used``, only coordinates it marks.
    """
    words = words_of(LOWER[data[offsets[0] : offsets[-1]]], offsets - offsets[0], ALPHANUMERIC)
    hashes = words.hashes()
    document = np.repeat(np.arange(len(offsets) - 1), words.counts)
    found = [(document, hashes)]
    for gap, factor in ((1, _PAIR), (2, _SKIP)):
        same = document[gap:] == document[:-gap]
        pair = mixed(hashes[:-gap] * factor + hashes[gap:])
        found.append((document[gap:][same], pair[same]))
    owner = np.concatenate([d for d, _ in found])
    place = (np.concatenate([h for _, h in found]) >> np.uint64(64 - BITS)).astype(np.int64)
    if used is not None:
        owner, place = owner[used[place]], place[used[place]]
    both = np.unique(owner << BITS | place)
    return both >> BITS, both & ((1 << BITS) - 1)


class Ftrl:
    """Follow the regularised leader, one coordinate-wise state; the last one is the intercept."""

    def __init__(self, size: int = 1 << BITS):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0.0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, at: np.ndarray, label: int) -> None:
        weights = self.weights(at)
        error = 1.0 / (1.0 + np.exp(-np.clip(weights.sum(), -35, 35))) - label
        n = self.n[at]
        grown = n + error * error
        self.z[at] += error - (np.sqrt(grown) - np.sqrt(n)) / ALPHA * weights
        self.n[at] = grown


def train(rows: Iterator[tuple[np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray, float]:
    """(coordinates, weights) that are not zero, and the intercept."""
    model, size = Ftrl(), 1 << BITS
    rows = [(np.r_[at, size], label) for at, label in rows]
    for _ in range(EPOCHS):
        for at, label in rows:
            model.learn(at, label)
    weights = model.weights()
    used = np.flatnonzero(weights[:size])
    return used, weights[used], float(weights[size])


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = document_bytes(batch.column(3))
        places: list[bytes] = []
        for begin, end in slices(offsets):
            owner, place = features(data, offsets[begin : end + 1])
            cuts = np.searchsorted(owner, np.arange(1, end - begin))
            places += [p.astype("<i4").tobytes() for p in np.split(place, cuts)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(places, pa.binary())],
            names=["doc_id", "label", "turn", "places"],
        )


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    for batch in batches:
        places, labels = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        rows += [(np.frombuffer(p, "<i4"), y) for p, y in zip(places, labels)]
    used, weights, intercept = train(rows)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([used.astype("<i4").tobytes()], pa.binary()),
            pa.array([weights.astype("<f8").tobytes()], pa.binary()),
            pa.array([intercept], pa.float64()),
        ],
        names=["used", "weights", "intercept"],
    )


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> tuple:
    """Sparse weights from a bounded sample of the documents that are not held out."""
    ids = labelled_ids(labels, label, FOLDS, HELD_OUT, TRAIN_ROWS)
    key = docs.schema["doc_id"].dataType.simpleString()
    rows = (
        text_bytes(docs, "doc_id")
        .join(F.broadcast(ids), "doc_id")
        .select("doc_id", "label", "turn", "body")
        .mapInArrow(_featured, f"doc_id {key}, label int, turn long, places binary")
    )
    bounded = rows.orderBy("turn", "doc_id", F.xxhash64("places")).limit(TRAIN_ROWS)
    learnt = (
        bounded.select("places", "label")
        .coalesce(1)
        .mapInArrow(_trained, "used binary, weights binary, intercept double")
        .collect()
    )
    if not learnt:
        return np.zeros(0, np.int32), np.zeros(0), 0.0
    row = learnt[0]
    return np.frombuffer(row.used, "<i4"), np.frombuffer(row.weights, "<f8"), row.intercept


def scores(docs: DataFrame, model: tuple) -> DataFrame:
    """(doc_id, score) of every document's whole text."""
    key = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used, weights, intercept = shared.value
        dense = np.zeros(1 << BITS)
        dense[used] = weights
        for batch in batches:
            data, offsets = document_bytes(batch.column(1))
            margins = np.full(batch.num_rows, intercept)
            for begin, end in slices(offsets):
                owner, place = features(data, offsets[begin : end + 1], dense != 0)
                margins[begin:end] += np.bincount(owner, dense[place], minlength=end - begin)
            score = 1.0 / (1.0 + np.exp(-np.clip(margins, -35, 35)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score, pa.float64())], names=["doc_id", "score"]
            )

    return text_bytes(docs, "doc_id").mapInArrow(run, f"doc_id {key}, score double")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = scores(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        (remainder_of_id("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
