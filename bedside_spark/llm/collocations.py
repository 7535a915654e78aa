"""Phrase collocations by dynamic itemset counting over cyclic shard scans.

The texts are dealt into ``SHARDS`` shards and scanned shard by shard, round and round. Words are
counted from the first shard on; a longer phrase is counted from the step after both its
subphrases (without its last and without its first word) reached the threshold, and for one full
cycle of shards. Lengths are therefore interleaved: one scan counts words, and already pairs,
triples and fours of what is known to be frequent. Scans end when every active phrase has seen
all shards. Each phrase that occurs often enough has frequent subphrases, so none is missed.

What the scans count and must know is a sketch per length: counters by a phrase's hash, and for
each the step at which it reached the threshold. A step sends counters only. Phrases that meet by
hash are counted together, so counters are upper bounds: more phrases may be active, and earlier,
never fewer. After the last cycle one more scan counts exactly, by their words, the phrases whose
counter reached the threshold. The sketch is bounded by ``MAX_CELLS`` bytes per length, counters
stop at the threshold; beyond its capacity it lets more phrases through, with the same result.

Exact counts number words by a dictionary and phrases by pairs of numbers. A task counts its texts
before it sends anything, so a word of every line is sent once per task. Phrases travel by the
bucket of their hash, a row per task and bucket: sorted, as one packed text with packed counts.

Defined results: a null or empty text has no words; a null language counts as ``und``; repeated rows
count again; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bedside_spark.llm.arrays import LOWER, byte_table, document_bytes, mixed, parted, slices, words_of
from bedside_spark.llm.frames import checkpointed, table, text_bytes, written
from bedside_spark.session import work_folder

LONGEST = 4
THRESHOLD = 30
#: A longer phrase with this share (in percent) of a candidate's places makes it redundant.
INSIDE_PERCENT = 80
TOP = 2_000
SCORE_SCALE = 2_000_000
SHARDS = 4
#: Bytes of the sketch of one length, and of text counted at once.
MAX_CELLS = 1 << 24
PART_BYTES = 2 << 20
#: Counters that travel together; phrases, and their bytes, that a task holds before it sums and sends them.
_BLOCK = 1 << 20
_HELD, _HELD_BYTES = 1_000_000, 128 << 20
#: Words of all texts for which there is a bucket of phrases, and the most buckets.
_BUCKET_WORDS, _BUCKETS = 2_000_000, 4_096

_SPLIT = byte_table(b".,;:!?\n\v\f\r")
_WORD = ~(_SPLIT | byte_table(b" \t"))
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _packed(values: np.ndarray | bytes) -> bytes:
    body = memoryview(values).cast("B")
    return len(body).to_bytes(8, "little") + pa.compress(body, codec="zstd", asbytes=True)


def _unpacked(body: bytes, dtype=np.uint8) -> np.ndarray:
    size = int.from_bytes(body[:8], "little")
    return np.frombuffer(pa.decompress(body[8:], size, codec="zstd"), dtype)


# ---- the sketch ---------------------------------------------------------------------------


def cells_for(words: int, threshold: int) -> int:
    """A power of two, four for every word that can be frequent, within the bound."""
    return min(MAX_CELLS, 1 << max(16, (4 * words // threshold).bit_length()))


def _added(counts: np.ndarray, more: np.ndarray, most: int) -> np.ndarray:
    """Sums of counters that stop at ``most``."""
    return np.minimum(counts.astype(np.int64) + more, most).astype(counts.dtype)


class Sketch:
    """Counters of phrases by length and hash, and the steps (from 1) at which they were full."""

    def __init__(self, cells: int, threshold: int, longest: int):
        self.cells, self.threshold = cells, threshold
        self.dtype = np.dtype(np.uint8 if threshold < 256 else np.uint32)
        self.counts = {k: np.zeros(cells, self.dtype) for k in range(1, longest + 1)}
        self.steps = {k: np.zeros(cells, np.uint8) for k in range(1, longest)}

    def packed_steps(self) -> tuple:
        return self.cells, {k: _packed(v) for k, v in self.steps.items()}

    def full(self) -> dict[int, bytes]:
        return {k: _packed(np.packbits(v >= self.threshold)) for k, v in self.counts.items()}

    def add(self, pieces: DataFrame, step: int) -> set[int]:
        """Add the counters of a step's tasks; the lengths of which some grew full."""
        grown = set()
        sums = (
            pieces.repartition("k", "block")
            .coalesce(pieces.sparkSession.sparkContext.defaultParallelism)
            .sortWithinPartitions("k", "block")
            .mapInArrow(_merged(self.dtype, self.threshold), "k int, block int, counts binary")
        )
        width = min(self.cells, _BLOCK)
        # One job for all blocks: they are a sketch at most, whatever the number of partitions.
        for r in sums.collect():
            own = slice(r.block * width, (r.block + 1) * width)
            counts = self.counts[r.k][own]
            counts[:] = _added(counts, _unpacked(r.counts, self.dtype), self.threshold)
            if r.k in self.steps:
                steps = self.steps[r.k][own]
                new = (counts >= self.threshold) & (steps == 0)
                steps[new] = step + 1
                grown |= {r.k} if new.any() else set()
        return grown


class Activity:
    """The steps of a sketch, as tasks read them."""

    def __init__(self, packed: tuple):
        self.cells, bodies = packed
        self.steps = {k: _unpacked(v) for k, v in bodies.items()}

    def cell(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes & np.uint64(self.cells - 1)).astype(np.int32)

    def at(self, k: int, hashes: np.ndarray) -> np.ndarray:
        return self.steps[k][self.cell(hashes)]


def _block_row(k: int, block: int, counts: np.ndarray) -> pa.RecordBatch:
    types = (pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array([v], t) for v, t in zip((k, block, _packed(counts)), types)], names=["k", "block", "counts"]
    )


class _Counters:
    """A task's counters: one array per length, given out block by block."""

    def __init__(self, cells: int, dtype: np.dtype, most: int):
        self.cells, self.dtype, self.most = cells, dtype, most
        self.held: dict[int, np.ndarray] = {}

    def count(self, k: int, cell: np.ndarray) -> None:
        counts = self.held.setdefault(k, np.zeros(self.cells, self.dtype))
        at, n = np.unique(cell, return_counts=True)
        counts[at] = _added(counts[at], n, self.most)

    def blocks(self) -> Iterator[pa.RecordBatch]:
        for k, counts in self.held.items():
            for block, part in enumerate(counts.reshape(-1, min(self.cells, _BLOCK))):
                if part.any():
                    yield _block_row(k, block, part)


def _merged(dtype: np.dtype, most: int):
    """Sums of blocks, which arrive sorted; holds one block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, counts = None, None
        for batch in batches:
            for k, block, body in zip(*(c.to_pylist() for c in batch.columns)):
                part = _unpacked(body, dtype)
                if current == (k, block):
                    counts = _added(counts, part, most)
                else:
                    if current:
                        yield _block_row(*current, counts)
                    current, counts = (k, block), part
        if current:
            yield _block_row(*current, counts)

    return run


# ---- counting a shard ---------------------------------------------------------------------


class _Part:
    """The words of some texts: their hashes and pieces, and phrases counted over them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: np.ndarray, names: list[str]):
        self.words, self.names = words_of(data, offsets, _WORD), names
        self.n = len(self.words.starts)
        part = np.repeat(np.arange(len(offsets) - 1), self.words.counts)
        #: Equal for words of one piece of one text.
        self.piece = np.cumsum(_SPLIT[data])[self.words.starts] + part if self.n else part
        self.lang = langs[part]
        salts = np.array([xxhash.xxh3_64_intdigest(n.encode()) for n in names], np.uint64)
        self.hashes = {1: mixed(self.words.hashes() + salts[self.lang])}

    def _hashes(self, k: int) -> np.ndarray:
        if k not in self.hashes:
            self.hashes[k] = mixed(self._hashes(k - 1)[:-1] * _STEP + self.hashes[1][k - 1 :])
        return self.hashes[k]

    def active(self, k: int, activity: Activity, step: int, cycle: int) -> np.ndarray:
        """Places where a phrase of ``k`` words begins that is to be counted at ``step``."""
        if self.n < k:
            return np.zeros(0, np.int64)
        inside = self.piece[: self.n - k + 1] == self.piece[k - 1 :]
        if k == 1:
            return np.flatnonzero(inside)
        steps = activity.at(k - 1, self._hashes(k - 1))
        first, second = steps[:-1], steps[1:]
        recent = np.maximum(first, second) > step - cycle
        return np.flatnonzero(inside & (first > 0) & (second > 0) & recent)

    def full(self, cells: int, bits: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
        """Places, by length, where a phrase begins whose counter and those of all its parts are full."""
        places, held = {}, np.ones(self.n + 1, bool)
        for k, own in sorted(bits.items()):
            if self.n < k:
                break
            inside = self.piece[: self.n - k + 1] == self.piece[k - 1 :]
            at = np.flatnonzero(inside & held[:-1] & held[1:])
            cell = (self._hashes(k)[at] & np.uint64(cells - 1)).astype(np.int64)
            places[k] = at[(own[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1]
            held = np.zeros(len(inside), bool)
            held[places[k]] = True
        return {k: v for k, v in places.items() if len(v)}

    def sizes(self) -> pa.RecordBatch:
        """The number of words of each language, as a phrase of no words."""
        n = np.bincount(self.lang, minlength=len(self.names))
        rows = ([0] * len(n), self.names, [0] * len(n), [""] * len(n), n)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, _HELD_ROWS)], schema=_HELD_ROWS)

    def counts(self, places: dict[int, np.ndarray], buckets: int) -> Iterator[pa.RecordBatch]:
        """(bucket, lang, k, phrase, n) of the phrases of each length that begin at its places."""
        used = np.zeros(self.n + 1, bool)
        for k, own in places.items():
            for i in range(k):
                used[own + i] = True
        chosen = np.flatnonzero(used)
        lengths = (self.words.ends - self.words.starts)[chosen]
        bounds = np.r_[0, np.cumsum(lengths)].astype(np.int32)
        body = self.words.data[np.repeat(self.words.starts[chosen] - bounds[:-1], lengths) + np.arange(bounds[-1])]
        column = pa.Array.from_buffers(
            pa.binary(), len(chosen), [None, pa.py_buffer(bounds), pa.py_buffer(body)]
        ).dictionary_encode()
        number = np.zeros(self.n + 1, np.int64)
        number[chosen] = column.indices.to_numpy()
        names, size = pa.array(self.names, pa.string()), len(column.dictionary)
        for k, own in places.items():
            # Phrases are numbered exactly, word by word, from the language on.
            codes, wide = self.lang[own].astype(np.int64), len(self.names)
            for i in range(k):
                codes, back, n = np.unique(
                    codes * size + number[own + i], return_inverse=True, return_counts=True
                )
                codes, wide = back, len(codes)
            at = np.zeros(wide, np.int64)
            at[codes] = own
            words = [column.dictionary.take(pa.array(number[at + i])) for i in range(k)]
            phrase = pc.binary_join_element_wise(*words, pa.scalar(b" ", pa.binary()))
            bucket = (self._hashes(k)[at] >> np.uint64(32)) % np.uint64(buckets)
            columns = [
                pa.array(bucket.astype(np.int32)),
                names.take(pa.array(self.lang[at])), pa.array(np.full(wide, k, np.int32)),
                phrase.cast(pa.string()), pa.array(n),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=_HELD_ROWS.names)


_COUNTED = pa.schema([("lang", pa.string()), ("k", pa.int32()), ("phrase", pa.string()), ("n", pa.int64())])
_COUNTED_SQL = "lang string, k int, phrase string, n long"
_HELD_ROWS = pa.schema([("bucket", pa.int32()), *_COUNTED])


def _summed(parts: list[pa.RecordBatch], schema: pa.Schema) -> list[pa.RecordBatch]:
    if len(parts) < 2:
        return parts
    table = pa.Table.from_batches(parts, schema)
    sums = table.group_by(schema.names[:-1], use_threads=False).aggregate([("n", "sum")])
    sums = sums.rename_columns({"n_sum": "n"}).select(schema.names)
    return sums.combine_chunks().to_batches(max_chunksize=100_000)


class _Held:
    """Counted rows, summed whenever many have come."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.parts, self.rows, self.bytes = schema, [], 0, 0

    def add(self, part: pa.RecordBatch) -> None:
        self.parts.append(part)
        self.rows += part.num_rows
        self.bytes += part.nbytes

    def sum(self) -> list[pa.RecordBatch]:
        self.parts = _summed(self.parts, self.schema)
        self.rows, self.bytes = sum(b.num_rows for b in self.parts), sum(b.nbytes for b in self.parts)
        return self.parts

    def over(self, share: float = 1) -> bool:
        return self.rows > share * _HELD or self.bytes > share * _HELD_BYTES


# ---- phrases on their way -----------------------------------------------------------------

#: The phrases of a bucket: languages, each phrase's language, length, count and bytes, the phrases.
_SENT = pa.schema([
    ("bucket", pa.int32()), ("langs", pa.list_(pa.string())),
    *((c, pa.binary()) for c in ("lang", "k", "n", "size", "phrases")),
])
_SENT_SQL = "bucket int, langs array<string>, lang binary, k binary, n binary, size binary, phrases binary"


def _sent(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Summed rows as a row for each bucket, alike phrases side by side."""
    if not parts:
        return
    rows = pa.Table.from_batches(parts, _HELD_ROWS).combine_chunks()
    langs = rows["lang"].combine_chunks().dictionary_encode()
    rows = rows.set_column(1, "lang", langs.indices)
    rows = rows.take(pc.sort_indices(rows["phrase"]))
    bucket, lang, k = (rows[c].to_numpy().astype(np.int64) for c in ("bucket", "lang", "k"))
    order = np.argsort((bucket * len(langs.dictionary) + lang) * (k.max() + 1) + k, kind="stable")
    rows = rows.take(pa.array(order))
    bounds = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        own = rows.slice(a, b - a)
        codes, lang = np.unique(own["lang"].to_numpy(), return_inverse=True)
        data, offsets = document_bytes(own["phrase"].combine_chunks().cast(pa.binary()))
        packed = (
            lang.astype(np.int32), own["k"].to_numpy().astype(np.uint8), own["n"].to_numpy(),
            np.diff(offsets).astype(np.int32), data[offsets[0] : offsets[-1]],
        )
        columns = [own["bucket"][0].as_py(), langs.dictionary.take(pa.array(codes)).to_pylist()]
        columns += [_packed(np.ascontiguousarray(v)) for v in packed]
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(columns, _SENT)], schema=_SENT)


def _received(row: dict) -> pa.RecordBatch:
    size = _unpacked(row["size"], np.int32)
    offsets = np.zeros(len(size) + 1, np.int32)
    np.cumsum(size, out=offsets[1:])
    body = [None, pa.py_buffer(offsets), pa.py_buffer(_unpacked(row["phrases"]))]
    columns = [
        pa.array(row["langs"], pa.string()).take(pa.array(_unpacked(row["lang"], np.int32))),
        pa.array(_unpacked(row["k"]).astype(np.int32)),
        pa.Array.from_buffers(pa.string(), len(size), body),
        pa.array(_unpacked(row["n"], np.int64)),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=_COUNTED)


def _sum_sent(threshold: int):
    """(lang, k, phrase, n) of whole buckets: phrases with ``threshold`` places, and sizes of languages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, after = _Held(_COUNTED), 0
        for batch in batches:
            for i in range(batch.num_rows):
                held.add(_received(batch.slice(i, 1).to_pylist()[0]))
                if held.over() and held.rows > 2 * after:
                    held.sum()
                    after = held.rows
        for part in held.sum():
            often = pc.or_(pc.equal(part["k"], 0), pc.greater_equal(part["n"], threshold))
            yield part.filter(often)

    return run


# ---- the scans of a task ------------------------------------------------------------------


def _parts(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[_Part]:
    """The texts of (lang, body) batches in parts of about ``most`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        langs = batch.column(0).dictionary_encode()
        names, codes = langs.dictionary.to_pylist(), langs.indices.to_numpy()
        data, offsets = document_bytes(batch.column(1))
        parts, owner = parted(data, offsets, lambda part: _SPLIT[part], most)
        for a, b in slices(parts, most):
            bounds = parts[a : b + 1]
            lower = LOWER[data[bounds[0] : bounds[-1]]]
            yield _Part(lower, bounds - bounds[0], codes[owner[a:b]], names)


def _scan(lengths: list[int], shared, step: int, cycle: int, most: int, dtype: np.dtype, threshold: int):
    """Counters of the phrases of a shard that are active at ``step``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        activity = Activity(shared.value)
        counters = _Counters(activity.cells, dtype, threshold)
        for part in _parts(batches, most):
            for k in lengths:
                places = part.active(k, activity, step, cycle)
                if len(places):
                    counters.count(k, activity.cell(part._hashes(k)[places]))
        yield from counters.blocks()

    return run


def _count_full(shared, most: int, buckets: int):
    """By bucket, the phrases whose counter is full with their counts, and the sizes of languages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, bodies = shared.value
        bits = {k: _unpacked(v) for k, v in bodies.items()}
        held = _Held(_HELD_ROWS)
        for part in _parts(batches, most):
            held.add(part.sizes())
            for found in part.counts(part.full(cells, bits), buckets):
                held.add(found)
            if held.over():
                held.sum()
                if held.over(0.5):
                    yield from _sent(held.parts)
                    held = _Held(_HELD_ROWS)
        yield from _sent(held.sum())

    return run


# ---- the cyclic scans ---------------------------------------------------------------------


def _deal(docs: DataFrame, folder: str, shards: int) -> DataFrame:
    """The texts written row by row into ``shards``: lang, body, shard."""
    bodies = text_bytes(docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text"), "lang")
    dealt = bodies.withColumn("shard", F.monotonically_increasing_id() % shards)
    dealt.write.partitionBy("shard").option("compression", "zstd").parquet(folder)
    return docs.sparkSession.read.schema("lang string, body binary, shard long").parquet(folder)


def counted(texts: DataFrame, sketch: Sketch, words: int, part_bytes: int) -> DataFrame:
    """The last scan: (lang, k, phrase, n) of phrases with enough places, and of languages (k 0).

    A bucket is a partition, and holds the phrases of ``_BUCKET_WORDS`` words or so.
    """
    spark = texts.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(partitions, min(_BUCKETS, words // _BUCKET_WORDS))
    full = spark.sparkContext.broadcast((sketch.cells, sketch.full()))
    sent = texts.select("lang", "body").mapInArrow(_count_full(full, part_bytes, buckets), _SENT_SQL)
    return sent.repartitionById(buckets, F.col("bucket")).mapInArrow(_sum_sent(sketch.threshold), _COUNTED_SQL)


def frequencies(
    docs: DataFrame,
    threshold: int = THRESHOLD,
    longest: int = LONGEST,
    shards: int = SHARDS,
    part_bytes: int = PART_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """(lang, k, phrase, n) of all phrases up to ``longest`` words with ``threshold`` places, and
    (lang, n), all words of each language. At most 60 shards.
    """
    spark, folder = docs.sparkSession, work_folder(docs.sparkSession, "phrases")
    texts = _deal(docs, f"{folder}/texts", shards)
    words = (texts.agg(F.sum(F.length("body"))).first()[0] or 0) // 6
    sketch = Sketch(cells_for(words, threshold), threshold, longest)
    grown_at: dict[int, int] = {}
    step = 0
    while True:
        lengths = [1] if step < shards else []
        lengths += [k for k in range(2, longest + 1) if grown_at.get(k - 1, -shards - 1) >= step - shards]
        if not lengths:
            break
        shared = spark.sparkContext.broadcast(sketch.packed_steps())
        scan = texts.where(F.col("shard") == step % shards).select("lang", "body")
        # A task for each core: what a step sends are so many sketches at most, however large the shard.
        scan = scan.coalesce(spark.sparkContext.defaultParallelism)
        counters = _scan(lengths, shared, step, shards, part_bytes, sketch.dtype, threshold)
        for k in sketch.add(scan.mapInArrow(counters, "k int, block int, counts binary"), step):
            grown_at[k] = step
        shared.unpersist()
        step += 1
    sums = written(counted(texts, sketch, words, part_bytes), "phrases")
    return sums.where("k > 0"), sums.where("k = 0").select("lang", "n")


# ---- candidates ---------------------------------------------------------------------------


def _words(first: str, n: str) -> str:
    return f"array_join(slice(w, {first}, {n}), ' ')"


def scored(frequent: DataFrame) -> DataFrame:
    """(lang, k, phrase, a, l, r, score) of the candidates, by their lowest-scoring cut."""
    split = frequent.where("k > 1").withColumn("w", F.split("phrase", " "))
    cuts = split.select(
        "lang", "k", "phrase", F.col("n").alias("a"),
        F.explode(F.expr(
            f"transform(sequence(1, k - 1), i -> struct(i as cut, {_words('1', 'i')} as first, "
            f"{_words('i + 1', 'k - i')} as rest))"
        )).alias("c"),
    ).select("lang", "k", "phrase", "a", "c.*")
    part = frequent.select("lang", F.col("phrase").alias("part"), F.col("n").alias("places"))
    left = part.withColumnsRenamed({"part": "first", "places": "l"})
    right = part.withColumnsRenamed({"part": "rest", "places": "r"})
    score = F.expr(
        f"(cast({SCORE_SCALE} as decimal(10, 0)) * cast(a as decimal(20, 0))) "
        "div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))"
    )
    judged = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumn("score", score)
    best = F.min(F.struct("score", "cut", "l", "r")).alias("best")
    lowest = judged.groupBy("lang", "k", "phrase", "a").agg(best)
    return lowest.select("lang", "k", "phrase", "a", "best.l", "best.r", "best.score")


def without_contained(candidates: DataFrame, percent: int = INSIDE_PERCENT) -> DataFrame:
    """Candidates but those that a longer candidate has inside nearly as often as they occur."""
    inside = candidates.where("k > 2").withColumn("w", F.split("phrase", " ")).select(
        "lang", F.col("a").alias("longer"),
        F.explode(F.expr(
            "flatten(transform(sequence(2, k - 1), q -> transform(sequence(1, k - q + 1), "
            f"i -> {_words('i', 'q')})))"
        )).alias("phrase"),
    )
    most = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    both = candidates.join(most, ["lang", "phrase"], "left")
    held = F.expr(f"cast(longer as decimal(20, 0)) * 100 >= cast(a as decimal(20, 0)) * {percent}")
    return both.where(~F.coalesce(held, F.lit(False))).drop("longer")


def collocations(
    docs: DataFrame, top: int = TOP, threshold: int = THRESHOLD, shards: int = SHARDS, **options
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases."""
    frequent, total = frequencies(docs, threshold, shards=shards, **options)
    found = without_contained(checkpointed(scored(frequent)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
