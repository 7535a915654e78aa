"""Token ids as Arrow files of equal-length sequences, written in id order and read at any place.

Documents are sorted by id into ranges of about ``SHARD_BYTES`` of text. A task encodes one range,
puts the end id behind every document and lays the ids one after another into sequences of
``length`` ids; only a range's last sequence is padded, and ``mask`` is false there. Each range is
one file in Arrow's IPC file format: every batch but the last holds ``BATCH_SEQUENCES`` rows of
``ids`` and ``mask``, both fixed-size lists, so sequence ``i`` is row ``i % BATCH_SEQUENCES`` of
batch ``i // BATCH_SEQUENCES`` and is a view of the mapped file. Ids take two bytes if the
vocabulary allows it. Which ids are whose is told by a Parquet index that Spark writes beside the
files: (doc_id, shard, start in the shard, n_tokens), in the same order.

A task writes under a name of its own and renames at its end, so a task that is tried again, or
runs twice, leaves one whole file with the same content.

Texts are cut where a byte-level tokenizer's pre-tokens always begin, each different piece is
encoded by the library once per worker, and the ids are gathered; long texts are cut there too, so
memory is bounded by ``PART_BYTES``. New pieces are encoded many at once where they may stand side
by side, and told apart by the bytes of their ids.

Defined results: a null or empty text has the end id only; rows come in the order of id, nulls
first, then of the text's hash; repeated rows are repeated; an empty table gives no files and no
rows; other columns are not read.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bedside_spark.llm.arrays import byte_table, document_bytes, parted, slices
from bedside_spark.llm.frames import table, text_bytes
from bedside_spark.session import work_folder

LENGTH = 1024
BATCH_SEQUENCES = 64
END_ID = 0
#: Bytes of text in a range, and of text encoded at once.
SHARD_BYTES = 128 << 20
PART_BYTES = 4 << 20
#: Different pieces of text whose ids a worker remembers.
REMEMBERED = 600_000
#: Pieces encoded as one text.
_JOINED = 500

_WIDE_BLANKS = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


# ---- encoding -----------------------------------------------------------------------------


def read_tokenizer(path: str | None = None) -> bytes:
    """The tokenizer file, read once by the driver and sent along with the tasks."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, "rb") as file:
        return file.read()


_BLANK, _MARK = byte_table(b" \t\n\v\f\r"), byte_table(b".,;:!?")
_LETTER = byte_table(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")


def _starts_piece(data: np.ndarray) -> np.ndarray:
    """Whether a pre-token begins at a byte, whatever stands around it.

    It does at white space behind anything else, at a letter behind a single line break, and at a
    punctuation mark behind a letter.
    """
    other = data > 0x20
    if _WIDE_BLANKS.search(data.tobytes().decode("utf-8", "replace")):
        other &= data < 0x80
    cut = np.zeros(len(data), bool)
    before, here = data[:-1], data[1:]
    cut[1:] = _BLANK[here] & other[:-1]
    cut[2:] |= _LETTER[data[2:]] & (data[1:-1] == 0x0A) & other[:-2]
    cut[1:] |= _MARK[here] & _LETTER[before]
    return cut


def _joins(piece: bytes) -> bool:
    """Whether a piece can stand before and behind others like it without changing its ids."""
    return len(piece) > 1 and piece[0] == 0x20 and 0x20 < piece[1] < 0x7F and 0x20 < piece[-1] < 0x7F


class Encoder:
    """The library's ids of whole texts, each different piece of text encoded once."""

    def __init__(self, tokenizer: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_buffer(tokenizer)
        size = self.library.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        #: Bytes of each id: a byte-level token has one character per byte.
        self.widths = np.array([len(self.library.id_to_token(i) or "") for i in range(size)])
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        #: Ids of all known pieces on end, and where each begins.
        self.ids = np.zeros(1 << 16, self.dtype)
        self.begins = np.zeros(1 << 14, np.int64)

    def _learn(self, pieces: list[bytes]) -> None:
        side_by_side = [p for p in pieces if _joins(p)]
        groups = [side_by_side[i : i + _JOINED] for i in range(0, len(side_by_side), _JOINED)]
        groups += [[p] for p in pieces if not _joins(p)]
        texts = [b"".join(group).decode() for group in groups]
        for group, found in zip(groups, self.library.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(found.ids, self.dtype)
            if len(group) == 1:
                self._store(group, ids, np.array([len(ids)]))
                continue
            ends = np.cumsum(self.widths[ids])
            wanted = np.cumsum([len(p) for p in group])
            places = np.searchsorted(ends, wanted) + 1
            if places[-1] == len(ids) and (ends[places - 1] == wanted).all():
                self._store(group, ids, places)
            else:  # not a byte-level tokenizer
                for piece in group:
                    own = self.library.encode(piece.decode(), add_special_tokens=False).ids
                    self._store([piece], np.array(own, self.dtype), np.array([len(own)]))

    def _store(self, pieces: list[bytes], ids: np.ndarray, ends: np.ndarray) -> None:
        n, base = len(self.known), int(self.begins[len(self.known)])
        if base + len(ids) > len(self.ids):
            self.ids = np.r_[self.ids, np.zeros(max(len(self.ids), len(ids)), self.dtype)]
        if n + len(pieces) >= len(self.begins):
            self.begins = np.r_[self.begins, np.zeros(len(self.begins) + len(pieces), np.int64)]
        self.ids[base : base + len(ids)] = ids
        self.begins[n + 1 : n + 1 + len(pieces)] = base + ends
        self.known.update(zip(pieces, range(n, n + len(pieces))))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts on end, number of ids of each)."""
        base = offsets[0]
        data, offsets = data[base : offsets[-1]], offsets - base
        cut = _starts_piece(data)
        cut[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(cut)
        if not len(starts):
            return np.zeros(0, self.dtype), np.zeros(len(offsets) - 1, np.int64)
        bounds = np.r_[starts, len(data)].astype(np.int32)
        column = pa.Array.from_buffers(
            pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))]
        ).dictionary_encode()
        pieces = column.dictionary.to_pylist()
        if len(self.known) > REMEMBERED:
            self._forget()
        new = [p for p in pieces if p not in self.known]
        if new:
            self._learn(new)
        own = np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))
        index = own[column.indices.to_numpy()]
        begins = self.begins[index]
        counts = self.begins[index + 1] - begins
        ends = np.cumsum(counts)
        taken = np.repeat(begins - (ends - counts), counts) + np.arange(ends[-1])
        total = np.r_[0, ends][np.searchsorted(starts, offsets)]
        return self.ids[taken], np.diff(total)


@functools.lru_cache(maxsize=1)
def _encoder(tokenizer: bytes) -> Encoder:
    """One encoder per worker, kept between its tasks."""
    return Encoder(tokenizer)


# ---- files --------------------------------------------------------------------------------


def _located(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def shard_path(folder: str, shard: int) -> str:
    return f"{folder.rstrip('/')}/sequences/shard-{shard:08d}.arrow"


def sequence_schema(dtype: np.dtype, length: int, end_id: int) -> pa.Schema:
    ids = pa.list_(pa.field("id", pa.from_numpy_dtype(dtype), nullable=False), length)
    mask = pa.list_(pa.field("real", pa.bool_(), nullable=False), length)
    told = {"length": str(length), "batch": str(BATCH_SEQUENCES), "end_id": str(end_id)}
    return pa.schema([pa.field("ids", ids), pa.field("mask", mask)], metadata=told)


class _Writer:
    """Appends ids to one file; holds the ids of at most one batch."""

    def __init__(self, folder: str, shard: int, dtype: np.dtype, length: int, end_id: int):
        self.system, where = _located(folder)
        self.final = shard_path(where, shard)
        self.own = f"{self.final}.{TaskContext.get().taskAttemptId()}.part"
        self.schema = sequence_schema(dtype, length, end_id)
        self.length, self.held = length, np.zeros(BATCH_SEQUENCES * length, dtype)
        self.n = self.total = 0
        self.system.create_dir(os.path.dirname(self.final), recursive=True)
        self.stream = self.system.open_output_stream(self.own)
        self.file = pa.ipc.new_file(self.stream, self.schema)

    def put(self, ids: np.ndarray) -> None:
        self.total += len(ids)
        while len(ids):
            take = min(len(ids), len(self.held) - self.n)
            self.held[self.n : self.n + take] = ids[:take]
            self.n += take
            ids = ids[take:]
            if self.n == len(self.held):
                self._flush()

    def _flush(self) -> None:
        rows = -(-self.n // self.length)
        filled = rows * self.length
        self.held[self.n : filled] = 0
        ids = pa.array(self.held[:filled].copy())
        mask = pa.array(np.arange(filled) < self.n)
        columns = [
            pa.FixedSizeListArray.from_arrays(values, type=field.type)
            for values, field in zip((ids, mask), self.schema)
        ]
        self.file.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        self.n = 0

    def close(self) -> None:
        if self.n:
            self._flush()
        self.file.close()
        self.stream.close()
        self.system.move(self.own, self.final)

    def discard(self) -> None:
        self.stream.close()
        self.system.delete_file(self.own)


class SequenceFile:
    """Random access to one shard; what it returns are views of the mapped file."""

    def __init__(self, folder: str, shard: int):
        system, where = _located(folder)
        path = shard_path(where, shard)
        local = isinstance(system, fs.LocalFileSystem)
        self.source = pa.memory_map(path) if local else system.open_input_file(path)
        self.file = pa.ipc.open_file(self.source)
        told = self.file.schema.metadata
        self.length, self.rows = int(told[b"length"]), int(told[b"batch"])
        self._last: tuple[int, np.ndarray | None, pa.RecordBatch | None] = (-1, None, None)

    def __len__(self) -> int:
        n = self.file.num_record_batches
        return (n - 1) * self.rows + self.file.get_batch(n - 1).num_rows if n else 0

    def _batch(self, number: int) -> tuple[np.ndarray, pa.RecordBatch]:
        if self._last[0] != number:
            batch = self.file.get_batch(number)
            self._last = (number, batch.column(0).flatten().to_numpy(zero_copy_only=True), batch)
        return self._last[1], self._last[2]

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids (a view) and mask of sequence ``i``."""
        ids, batch = self._batch(i // self.rows)
        row = i % self.rows
        mask = batch.column(1)[row].values.to_numpy(zero_copy_only=False)
        return ids[row * self.length : (row + 1) * self.length], mask

    def span(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The ``n`` ids from place ``start`` on, as views of the batches they lie in."""
        whole = self.rows * self.length
        while n > 0:
            ids, _ = self._batch(start // whole)
            part = ids[start % whole : start % whole + n]
            yield part
            start, n = start + len(part), n - len(part)

    def close(self) -> None:
        self._last = (-1, None, None)
        self.source.close()


# ---- jobs ---------------------------------------------------------------------------------

_INDEX = "shard int, start long, n_tokens long"


def _write_range(folder: str, tokenizer, length: int, end_id: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = _encoder(tokenizer.value), TaskContext.get().partitionId()
        writer = None
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                writer = writer or _Writer(folder, shard, encoder.dtype, length, end_id)
                data, offsets = document_bytes(batch.column(1))
                parts, owner = parted(data, offsets, _starts_piece, most)
                last = np.r_[owner[1:] != owner[:-1], True]
                begin, sizes = writer.total, np.zeros(batch.num_rows, np.int64)
                for a, b in slices(parts, most):
                    ids, counts = encoder.encode(data, parts[a : b + 1])
                    writer.put(np.insert(ids, np.cumsum(counts)[last[a:b]], end_id))
                    np.add.at(sizes, owner[a:b], counts + last[a:b])
                starts = begin + np.cumsum(sizes) - sizes
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), pa.array([shard] * len(sizes), pa.int32()),
                        pa.array(starts), pa.array(sizes),
                    ],
                    names=["doc_id", "shard", "start", "n_tokens"],
                )
            if writer:
                writer.close()
        except BaseException:
            if writer:
                writer.discard()
            raise

    return run


def write_sequences(
    docs: DataFrame,
    folder: str,
    tokenizer: bytes | None = None,
    length: int = LENGTH,
    end_id: int = END_ID,
    shard_bytes: int = SHARD_BYTES,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Write the files and the index below ``folder``; the index, one row per document."""
    spark = docs.sparkSession
    key = docs.schema["doc_id"].dataType.simpleString()
    shared = spark.sparkContext.broadcast(tokenizer or read_tokenizer())
    bodies = text_bytes(docs, "doc_id")
    size = bodies.agg(F.sum(F.length("body"))).first()[0] or 0
    ranges = max(3 * spark.sparkContext.defaultParallelism, -(-size // shard_bytes))
    # Ids may be null or repeated: ranges may also fall between texts, and between equal rows.
    order = bodies.withColumns({"mark": F.xxhash64("body"), "row": F.monotonically_increasing_id()})
    rows = order.repartitionByRange(ranges, "doc_id", "mark", "row").sortWithinPartitions(
        "doc_id", "mark", "row"
    )
    index = rows.select("doc_id", "body").mapInArrow(
        _write_range(folder, shared, length, end_id, part_bytes), f"doc_id {key}, {_INDEX}"
    )
    index.write.parquet(f"{folder}/index")
    return spark.read.parquet(f"{folder}/index")


def shard_starts(index: DataFrame) -> DataFrame:
    """(shard, before): ids in all earlier shards. One row per file goes through the driver."""
    sums = index.groupBy("shard").agg(F.sum("n_tokens").alias("n")).orderBy("shard").collect()
    before = np.cumsum([0, *(r.n for r in sums)])[:-1].tolist()
    rows = [(r.shard, b) for r, b in zip(sums, before)]
    return index.sparkSession.createDataFrame(rows, "shard int, before long")


def _read_spans(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, file = None, None
        for batch in batches:
            ids, before, shards, starts, counts = (batch.column(i) for i in range(5))
            sums = []
            for shard, start, n in zip(shards.to_pylist(), starts.to_pylist(), counts.to_pylist()):
                if shard != current:
                    if file:
                        file.close()
                    current, file = shard, SequenceFile(folder, shard)
                crc = 0
                for part in file.span(start, n):
                    crc = zlib.crc32(part.astype("<u4"), crc)
                sums.append(crc)
            first = np.asarray(before) + np.asarray(starts)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(first, pa.int64()), counts, pa.array(sums, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )
        if file:
            file.close()

    return run


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, its ids read from the files."""
    index = spark.read.parquet(f"{folder}/index")
    key = index.schema["doc_id"].dataType.simpleString()
    placed = index.join(F.broadcast(shard_starts(index)), "shard")
    return placed.select("doc_id", "before", "shard", "start", "n_tokens").mapInArrow(
        _read_spans(folder), f"doc_id {key}, start long, n_tokens long, ids_crc32 long"
    )


def op13_arrow_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark, "sequences")
    write_sequences(table(spark, sf_dir, "documents"), folder)
    return read_documents(spark, folder)
