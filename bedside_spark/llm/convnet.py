"""Quality classifier: a byte-level convolutional network in numpy.

A text is cut into overlapping chunks that cover all of it. Bytes are embedded, learned filters
run over each chunk and are max-pooled there; a document is the greatest, the mean and the least
of its chunks' pooled values, which a small hidden layer combines into one probability. The least
tells texts that hold few different things, such as one word over and over.

Training takes whole texts of at most ``TRAIN_ROWS`` labelled documents. Only the positions that
won a maximum get gradients, so a step costs little more than scoring.

Defined results: a null or empty text is one chunk of padding; without labelled documents every
score is 0.5; a null id is held out by the remainder of the empty text; repeated rows give
repeated results; only id, text and, for training, ``labels`` are read; an empty table gives an
empty result.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bedside_spark.llm.frames import remainder_of_id, table, text_bytes
from bedside_spark.llm.samples import labelled_ids

TRAIN_ROWS = 3_000
STEPS = 750
MINIBATCH = 32
RATE = 0.01
CHUNK, OVERLAP = 512, 16
WIDTH, STRIDE = 6, 2
EMBEDDING, FILTERS, HIDDEN = 8, 24, 16
#: Chunks convolved at once.
_BLOCK = 64
FOLDS, HELD_OUT = 4, 2
_PAD = 256


def chunks_of(body: bytes) -> np.ndarray:
    """Overlapping chunks that cover the text, the last one padded."""
    step = CHUNK - OVERLAP
    n = max(1, -(-max(0, len(body) - OVERLAP) // step))
    flat = np.full((n - 1) * step + CHUNK, _PAD, np.int16)
    flat[: len(body)] = np.frombuffer(body, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(flat, CHUNK)[::step]


class Network:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.p = {
            "embedding": rng.normal(0, 0.5, (_PAD + 1, EMBEDDING)),
            "filters": rng.normal(0, 0.3, (WIDTH * EMBEDDING, FILTERS)),
            "offset": np.zeros(FILTERS),
            "hidden": rng.normal(0, 0.3, (3 * FILTERS, HIDDEN)),
            "hidden_offset": np.zeros(HIDDEN),
            "out": rng.normal(0, 0.3, (HIDDEN, 1)),
            "out_offset": np.zeros(1),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def pooled(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greatest response of each filter in each chunk, and where it was."""
        p, values, where = self.p, [], []
        starts = np.arange(0, CHUNK - WIDTH + 1, STRIDE)
        for at in range(0, len(chunks), _BLOCK):
            block = p["embedding"][chunks[at : at + _BLOCK]]
            rows = np.lib.stride_tricks.sliding_window_view(block, WIDTH, axis=1)[:, ::STRIDE]
            rows = rows.transpose(0, 1, 3, 2).reshape(-1, WIDTH * EMBEDDING)
            response = (rows @ p["filters"]).reshape(len(block), len(starts), FILTERS)
            best = response.argmax(axis=1)
            values.append(np.take_along_axis(response, best[:, None], 1)[:, 0])
            where.append(best)
        value = np.concatenate(values) + p["offset"]
        return np.tanh(value), np.concatenate(where)

    def combine(self, pooled: np.ndarray, first: np.ndarray) -> tuple:
        """Document features from chunk values, hidden values and probabilities."""
        counts = np.diff(np.r_[first, len(pooled)])[:, None]
        mean = np.add.reduceat(pooled, first) / counts
        greatest, least = np.maximum.reduceat(pooled, first), np.minimum.reduceat(pooled, first)
        whole = np.concatenate([greatest, mean, least], axis=1)
        hidden = np.tanh(whole @ self.p["hidden"] + self.p["hidden_offset"])
        margin = (hidden @ self.p["out"])[:, 0] + self.p["out_offset"][0]
        return whole, hidden, 1.0 / (1.0 + np.exp(-np.clip(margin, -30, 30)))

    def scores(self, bodies: list[bytes]) -> np.ndarray:
        out = np.zeros(len(bodies))
        begin = 0
        while begin < len(bodies):
            held, n = [], 0
            while begin + len(held) < len(bodies) and (not held or n < 4 * _BLOCK):
                held.append(chunks_of(bodies[begin + len(held)]))
                n += len(held[-1])
            sizes = np.array([len(h) for h in held])
            pooled = np.concatenate([self.pooled(h)[0] for h in held]) if n > 8 * _BLOCK else (
                self.pooled(np.concatenate(held))[0]
            )
            out[begin : begin + len(held)] = self.combine(pooled, np.cumsum(sizes) - sizes)[2]
            begin += len(held)
        return out

    def gradients(self, held: list[np.ndarray], labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss of some documents given as chunks."""
        p = self.p
        sizes = np.array([len(h) for h in held])
        first, chunks = np.cumsum(sizes) - sizes, np.concatenate(held)
        owner = np.repeat(np.arange(len(held)), sizes)
        pooled, where = self.pooled(chunks)
        whole, hidden, score = self.combine(pooled, first)
        error = ((score - labels) / len(labels)).astype(np.float32)[:, None]
        g = {"out": hidden.T @ error, "out_offset": error.sum(axis=0)}
        back = (error @ p["out"].T) * (1 - hidden**2)
        g["hidden"], g["hidden_offset"] = whole.T @ back, back.sum(axis=0)
        top, mean, low = np.split(back @ p["hidden"].T, 3, axis=1)
        greatest, least = whole[:, :FILTERS], whole[:, 2 * FILTERS :]
        flow = mean[owner] / sizes[owner][:, None]
        for extreme, gradient in ((greatest, top), (least, low)):
            won = pooled == extreme[owner]
            ties = np.add.reduceat(won.astype(np.int64), first)
            flow += np.where(won, (gradient / ties)[owner], 0)
        flow = (flow * (1 - pooled**2)).astype(np.float32)
        g["offset"] = flow.sum(axis=0)
        g["filters"] = np.zeros_like(p["filters"])
        g["embedding"] = np.zeros_like(p["embedding"])
        row = np.arange(len(chunks))
        for f in range(FILTERS):
            places = where[:, f, None] * STRIDE + np.arange(WIDTH)
            symbols = chunks[row[:, None], places]
            inputs = p["embedding"][symbols].reshape(len(chunks), -1)
            g["filters"][:, f] = inputs.T @ flow[:, f]
            spread = flow[:, f, None, None] * p["filters"][:, f].reshape(1, WIDTH, EMBEDDING)
            np.add.at(g["embedding"], symbols.ravel(), spread.reshape(-1, EMBEDDING))
        return g

    def train(self, bodies: list[bytes], labels: list[int], seed: int = 11) -> Network:
        """``STEPS`` steps of Adam over minibatches, in an order fixed by the seed."""
        rng, target = np.random.default_rng(seed), np.array(labels, np.float32)
        mean = {k: np.zeros_like(v) for k, v in self.p.items()}
        square = {k: np.zeros_like(v) for k, v in self.p.items()}
        order = np.zeros(0, np.int64)
        for step in range(1, STEPS + 1):
            if not len(order):
                order = rng.permutation(len(bodies))
            some, order = order[:MINIBATCH], order[MINIBATCH:]
            g = self.gradients([chunks_of(bodies[i]) for i in some], target[some])
            rate = RATE * (1 - step / (STEPS + 1))
            for k, v in g.items():
                mean[k] += 0.1 * (v - mean[k])
                square[k] += 0.01 * (v * v - square[k])
                up = mean[k] / (1 - 0.9**step)
                self.p[k] -= rate * up / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-7)
        return self


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bodies, labels = [], []
    for batch in batches:
        bodies += [b or b"" for b in batch.column(0).to_pylist()]
        labels += batch.column(1).to_pylist()
    weights = pickle.dumps(Network().train(bodies, labels).p)
    yield pa.RecordBatch.from_arrays([pa.array([weights], pa.binary())], names=["weights"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Network | None:
    """A network trained on a bounded sample of the documents that are not held out."""
    ids = labelled_ids(labels, label, FOLDS, HELD_OUT, TRAIN_ROWS)
    rows = text_bytes(docs, "doc_id").join(F.broadcast(ids), "doc_id")
    bounded = rows.orderBy("turn", "doc_id", F.xxhash64("body")).limit(TRAIN_ROWS)
    learnt = bounded.select("body", "label").coalesce(1).mapInArrow(_trained, "weights binary")
    found = learnt.collect()
    if not found:
        return None
    network = Network()
    network.p = pickle.loads(bytes(found[0].weights))
    return network


def scores(docs: DataFrame, network: Network | None) -> DataFrame:
    """(doc_id, score) of every document's whole text."""
    key = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = shared.value
        for batch in batches:
            bodies = [b or b"" for b in batch.column(1).to_pylist()]
            found = np.full(len(bodies), 0.5) if network is None else network.scores(bodies)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.float64())], names=["doc_id", "score"]
            )

    return text_bytes(docs, "doc_id").mapInArrow(run, f"doc_id {key}, score double")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = scores(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        (remainder_of_id("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )
