"""Substring dedup: windows of words that occur twice, behind a count-min prefilter.

Narrow scans of the texts and two shuffles:

1. every partition sketches the 64-bit hashes of its windows; partition sketches are merged
   block by block into saturating counters, of which only "two or more" is kept (one bit). The
   second row of the sketch counts only windows that the first says are repeated, which takes
   one more scan and makes it small;
2. windows whose counters in both rows say "two or more" are grouped exactly, by 128 bits: the
   smallest hash of their half-windows and a digest of their words. Neighbouring windows mostly
   share that smallest hash and travel as one row; a hash that very many windows share, as in a
   large group of near copies, is split into its windows. Windows met twice in one chunk of a task are
   settled there and only announced once, so a passage in a third of all texts arrives as one
   row per chunk; after the shuffle the rest is sorted and compared one row at a time;
3. words covered by repeated windows are removed. Rows are matched by a digest of the whole
   text, so ids may repeat or be null; texts met twice in one batch are settled there.

Counters never underestimate, so no repeated window is lost. The sketch has ``CELLS_PER_WINDOW``
counters per window up to ``MAX_CELLS``, which bounds what is broadcast at 96 MB; beyond that
it lets more windows through and the second pass does more, with the same result.

Defined results: a null or empty text has no words and keeps an empty text; a text of fewer
words than a window keeps all; equal texts are elsewhere for each other; an empty table gives
an empty result; columns other than the id and the text are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from bedside_spark.llm.arrays import NOT_BLANK, Words, document_bytes, mixed, slices, words_of
from bedside_spark.llm.frames import checkpointed, table, text_bytes

WINDOW = 35
PART = 17
CELLS_PER_WINDOW = 4
MAX_CELLS = 1 << 29
_BLOCK_BITS = 20
#: Windows sketched or compared at once by a task.
_CHUNK = 1_000_000
_CANDIDATES = 250_000
#: A key with more than this share of all candidate windows is split into its windows.
_HEAVY_SHARE = 1e-4
_HEAVY_IN_CHUNK = 8


# ---- the sketch ---------------------------------------------------------------------------


def _cells(hashes: np.ndarray, row: int, cells: int) -> np.ndarray:
    """Counter of each hash in one row of the sketch."""
    salted = mixed(hashes + np.uint64(0xA0761D6478BD642F) * np.uint64(row)) if row else hashes
    return salted & np.uint64(cells - 1)


def _packed(cells: np.ndarray) -> bytes:
    """Ascending cells of a block as compressed gaps, low bytes apart from high bytes."""
    gaps = np.diff(cells, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4)
    return zlib.compress(np.ascontiguousarray(gaps.T).tobytes(), 1)


def _unpacked(body: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(body), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel())


def _pieces(hashes: np.ndarray, row: int, cells: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(block, cells counted once, cells counted more) of one chunk's sketch."""
    found, counts = np.unique(_cells(hashes, row, cells), return_counts=True)
    found = found.astype(np.int64)
    block = found >> _BLOCK_BITS
    edges = np.flatnonzero(np.r_[True, block[1:] != block[:-1], True][: len(block) + 1])
    for a, b in zip(edges[:-1], edges[1:]):
        inside, once = found[a:b] & ((1 << _BLOCK_BITS) - 1), counts[a:b] == 1
        yield int(block[a]), _packed(inside[once]), _packed(inside[~once])


def _sketch(size: int, row: int, cells: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        earlier, held, n = _Filter(shared), [], 0

        def flush() -> pa.RecordBatch:
            blocks, once, more = zip(*_pieces(np.concatenate(held), row, cells))
            return pa.RecordBatch.from_arrays(
                [pa.array(blocks, pa.int32()), pa.array(once, pa.binary()), pa.array(more, pa.binary())],
                names=["block", "once", "more"],
            )

        for batch in batches:
            data, offsets = document_bytes(batch.column(0))
            for begin, end in slices(offsets):
                hashes = words_of(data, offsets[begin : end + 1], NOT_BLANK).windows(size)[1]
                hashes = hashes[earlier.passes(hashes)]
                if len(hashes):
                    held.append(hashes)
                    n += len(hashes)
                if n >= _CHUNK:
                    yield flush()
                    held, n = [], 0
        if n:
            yield flush()

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the pieces of each block, which arrive sorted by block; holds one block."""
    current, counts = None, np.zeros(1 << _BLOCK_BITS, np.uint8)

    def bits() -> pa.RecordBatch:
        body = zlib.compress(np.packbits(counts >= 2).tobytes(), 1)
        return pa.RecordBatch.from_arrays(
            [pa.array([current], pa.int32()), pa.array([body], pa.binary())],
            names=["block", "bits"],
        )

    for batch in batches:
        for block, once, more in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if block != current:
                if current is not None:
                    yield bits()
                    counts[:] = 0
                current = block
            cells = _unpacked(once)
            counts[cells] = np.minimum(counts[cells] + 1, 2)
            counts[_unpacked(more)] = 2
    if current is not None:
        yield bits()


def cells_for(windows: int) -> int:
    """A power of two of counters per row for so many windows, within the bound."""
    wanted = max(1 << 16, CELLS_PER_WINDOW * windows)
    return min(MAX_CELLS, 1 << (wanted - 1).bit_length())


def sketch(bodies: DataFrame, size: int, cells: int | None = None) -> list:
    """Broadcast rows of the merged sketch, each (cells, block number to compressed bits)."""
    context = bodies.sparkSession.sparkContext
    if cells is None:
        # A word and its blank take six bytes in most languages.
        n = bodies.agg(F.sum(F.length("body"))).first()[0] or 0
        cells = cells_for(n // 6)
    rows: list = []
    for row, width in enumerate((cells, max(cells // 2, 1 << 10))):
        pieces = bodies.select("body").mapInArrow(
            _sketch(size, row, width, list(rows)), "block int, once binary, more binary"
        )
        merged = (
            pieces.repartition("block")
            .sortWithinPartitions("block")
            .mapInArrow(_merge, "block int, bits binary")
            .collect()
        )
        rows.append(context.broadcast((width, {r.block: bytes(r.bits) for r in merged})))
    return rows


class _Filter:
    """Bit arrays of the merged rows of the sketch."""

    def __init__(self, shared: list):
        self.rows = []
        for row in shared:
            cells, blocks = row.value
            width = (1 << _BLOCK_BITS) // 8
            bits = np.zeros(max(1, cells >> _BLOCK_BITS) * width, np.uint8)
            for block, body in blocks.items():
                part = np.frombuffer(zlib.decompress(body), np.uint8)
                bits[block * width : (block + 1) * width] = part
            self.rows.append((cells, bits))

    def passes(self, hashes: np.ndarray) -> np.ndarray:
        """Indices of the hashes all of whose counters reach two."""
        index = np.arange(len(hashes))
        for row, (cells, bits) in enumerate(self.rows):
            cell = _cells(hashes[index], row, cells)
            byte = bits[(cell >> np.uint64(3)).astype(np.int64)]
            index = index[(byte >> (7 - (cell & np.uint64(7))).astype(np.uint8)) & 1 == 1]
        return index


# ---- exact comparison ---------------------------------------------------------------------

_RUNS = pa.schema([
    ("key", pa.int64()), ("text_hi", pa.int64()), ("text_lo", pa.int64()),
    ("places", pa.list_(pa.int32())), ("digests", pa.list_(pa.int64())),
])
_RUNS_SQL = "key long, text_hi long, text_lo long, places array<int>, digests array<long>"
_PLACES_SQL = "text_hi long, text_lo long, many array<int>"


def _halves(digests: list[int]) -> np.ndarray:
    raw = b"".join(d.to_bytes(16, "big") for d in digests)
    return np.frombuffer(raw, ">i8").astype(np.int64).reshape(-1, 2)


def _runs(differs: np.ndarray) -> np.ndarray:
    """First index of each run, given where an element differs from the one before."""
    return np.flatnonzero(np.r_[True, differs])


def _lists(values: np.ndarray, starts: np.ndarray) -> pa.ListArray:
    """The runs of ``values`` that begin at ``starts`` as one list each."""
    return pa.ListArray.from_arrays(np.r_[starts, len(values)].astype(np.int32), values)


def _settled(keys, digests, texts, places) -> Iterator[tuple]:
    """Columns of ``_RUNS`` from the candidates of one chunk, in the order of the texts.

    Windows met once travel with their places, those with one key and text in one row. One met
    more often is repeated whatever comes, so it is only announced (no places), and its places
    travel per text without digests.
    """
    order = np.lexsort((digests, keys))
    k, d = keys[order], digests[order]
    first = _runs((k[1:] != k[:-1]) | (d[1:] != d[:-1]))
    count = np.diff(np.r_[first, len(order)])
    repeated = np.repeat(count > 1, count)
    single = np.sort(order[~repeated])
    if len(single):
        k, t = keys[single], texts[single]
        cut = _runs((k[1:] != k[:-1]) | (t[1:] != t[:-1]).any(axis=1))
        yield k[cut], t[cut, 0], t[cut, 1], _lists(places[single], cut), _lists(digests[single], cut)
    known = order[first[count > 1]]
    if len(known):
        k = keys[known]
        cut = _runs(k[1:] != k[:-1])
        none = np.zeros(len(cut), np.int64)
        yield k[cut], none, none, [None] * len(cut), _lists(digests[known], cut)
        chosen = np.sort(order[repeated])
        t = texts[chosen]
        cut = _runs((t[1:] != t[:-1]).any(axis=1))
        yield t[cut, 0], t[cut, 0], t[cut, 1], _lists(places[chosen], cut), [None] * len(cut)


def _key_counts(size: int, shared: list):
    """(key, windows) of the keys that are frequent in a chunk, and of all as key null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen, held, n = _Filter(shared), [], 0

        def flush() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= _HEAVY_IN_CHUNK
            listed = pa.array([*keys[often].tolist(), None], pa.int64())
            return pa.RecordBatch.from_arrays(
                [listed, pa.array(np.r_[counts[often], n], pa.int64())], names=["key", "windows"]
            )

        for batch in batches:
            data, offsets = document_bytes(batch.column(0))
            for begin, end in slices(offsets):
                words = words_of(data, offsets[begin : end + 1], NOT_BLANK)
                first, hashes = words.windows(size)
                first = first[chosen.passes(hashes)]
                if len(first):
                    held.append(_keys(words, first, size))
                    n += len(first)
                if n >= _CANDIDATES:
                    yield flush()
                    held, n = [], 0
        if n:
            yield flush()

    return run


def heavy_keys(bodies: DataFrame, size: int, shared: list) -> np.ndarray:
    """Keys of more than ``_HEAVY_SHARE`` of the candidate windows; at most one over that many."""
    counts = bodies.select("body").mapInArrow(_key_counts(size, shared), "key long, windows long")
    sums = checkpointed(counts.groupBy("key").agg(F.sum("windows").alias("windows")))
    total = sums.where("key is null").agg(F.sum("windows")).first()[0] or 0
    found = sums.where(F.col("key").isNotNull() & (F.col("windows") > total * _HEAVY_SHARE))
    return np.array(sorted(r.key for r in found.select("key").collect()), np.int64)


def _keys(words: Words, first: np.ndarray, size: int) -> np.ndarray:
    """Smallest hash of the half-windows in each window."""
    part = min(PART, size)
    begin, hashes = words.windows(part)
    by_word = np.zeros(len(words.starts), np.uint64)
    by_word[begin] = hashes
    span = np.lib.stride_tricks.sliding_window_view(by_word, size - part + 1)
    return span[first].min(axis=1).view(np.int64)


def _candidates(size: int, shared: list, heavy):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen, split, held, n = _Filter(shared), heavy.value, [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            for columns in _settled(*(np.concatenate(part) for part in zip(*held))):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, _RUNS)], schema=_RUNS
                )

        for batch in batches:
            data, offsets = document_bytes(batch.column(0))
            for begin, end in slices(offsets):
                words = words_of(data, offsets[begin : end + 1], NOT_BLANK)
                first, hashes = words.windows(size)
                first = first[chosen.passes(hashes)]
                if len(first):
                    held.append(_described(words, first, size, split))
                    n += len(first)
                if n >= _CANDIDATES:
                    yield from flush()
                    held, n = [], 0
        if n:
            yield from flush()

    return run


def _described(words: Words, first: np.ndarray, size: int, heavy: np.ndarray) -> tuple:
    """(keys, digests, text digests, places) of the candidate windows starting at ``first``.

    A window of a heavy key gets a key of its own, from both.
    """
    keys = _keys(words, first, size)
    document = np.searchsorted(words.first, first, "right") - 1
    whole = words.data.tobytes()
    digests: list[int] = []
    texts: list[int] = []
    digest = xxhash.xxh3_64_intdigest
    for d in np.unique(document).tolist():
        body = whole[words.offsets[d] : words.offsets[d + 1]]
        a, b = words.first[d], words.first[d + 1]
        line = b" ".join(body.split())
        ends = np.cumsum(words.ends[a:b] - words.starts[a:b] + 1) - 1
        begins = np.r_[0, ends[:-1] + 1]
        own = first[np.searchsorted(first, a) : np.searchsorted(first, b)] - a
        spans = zip(begins[own].tolist(), ends[own + size - 1].tolist())
        digests += [digest(line[x:y]) for x, y in spans]
        texts += [xxhash.xxh3_128_intdigest(body)] * len(own)
    places = (first - words.first[document]).astype(np.int32)
    told = np.array(digests, np.uint64)
    if len(heavy):
        own = keys.view(np.uint64) + mixed(told)
        keys = np.where(np.isin(keys, heavy), own.view(np.int64), keys)
    return keys, told.view(np.int64), _halves(texts), places


def _expanded(runs: DataFrame) -> DataFrame:
    """One row per window, ``at`` -1 if only announced; settled places of a text stay one row."""
    window = F.transform(
        "digests",
        lambda digest, i: F.struct(
            digest.alias("digest"),
            F.coalesce(F.get("places", i), F.lit(-1)).alias("at"),
            F.lit(None).cast("array<int>").alias("many"),
        ),
    )
    settled = F.struct(
        F.lit(0).cast("long").alias("digest"), F.lit(-1).alias("at"), F.col("places").alias("many")
    )
    rows = F.when(F.col("digests").isNull(), F.array(settled)).otherwise(window)
    return runs.select("key", "text_hi", "text_lo", F.explode(rows).alias("row")).select(
        "key", "row.digest", "text_hi", "text_lo", "row.at", "row.many"
    )


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From windows sorted by key and digest, the places of all that occur twice or are announced.

    Only the first row of a window is held until it is known whether another follows; places
    are gathered by text before they go out.
    """
    before = None  # (key, digest) and its place, None if that is given out or was announced
    held: list[np.ndarray] = []
    n = 0

    def flush() -> pa.RecordBatch:
        rows = np.concatenate(held)
        rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
        cut = _runs((rows[1:, :2] != rows[:-1, :2]).any(axis=1))
        return _places(rows[cut, 0], rows[cut, 1], _lists(rows[:, 2].astype(np.int32), cut))

    for batch in batches:
        if not batch.num_rows:
            continue
        key, digest, text_hi, text_lo, at = (batch.column(i).to_numpy() for i in range(5))
        carries = batch.column(5).is_valid().to_numpy(zero_copy_only=False)
        if carries.any():
            ready = batch.filter(pa.array(carries))
            yield _places(*(ready.column(i) for i in (2, 3, 5)))
        new = np.r_[True, (key[1:] != key[:-1]) | (digest[1:] != digest[:-1])]
        going_on = before is not None and (key[0], digest[0]) == before[0]
        new[0] = not going_on
        group, told = np.cumsum(new), at < 0
        count = np.bincount(group[~carries], minlength=group[-1] + 1)
        count += np.bincount(group[~carries & told], minlength=len(count))
        if going_on:
            if before[1] is not None and count[0]:
                held.append(np.array([before[1]], np.int64))
                n += 1
            count[0] += 1 if before[1] is not None else 2
        give = ~carries & ~told & (count[group] > 1)
        held.append(np.stack([text_hi[give], text_lo[give], at[give].astype(np.int64)], 1))
        n += int(give.sum())
        seen = count[group[-1]]
        pending = (text_hi[-1], text_lo[-1], at[-1]) if seen == 1 else None
        before = ((key[-1], digest[-1]), pending) if seen else None
        if n >= _CHUNK:
            yield flush()
            held, n = [], 0
    if n:
        yield flush()


def _places(text_hi, text_lo, many) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(text_hi, pa.int64()), pa.array(text_lo, pa.int64()), many],
        names=["text_hi", "text_lo", "many"],
    )


def repeated_places(docs: DataFrame, size: int = WINDOW, cells: int | None = None) -> DataFrame:
    """(text_hi, text_lo, many): starts of windows whose words also start elsewhere.

    The text is named by its 128-bit digest and may have several rows.
    """
    bodies = text_bytes(docs)
    shared = sketch(bodies, size, cells=cells)
    heavy = docs.sparkSession.sparkContext.broadcast(heavy_keys(bodies, size, shared))
    found = bodies.mapInArrow(_candidates(size, shared, heavy), _RUNS_SQL)
    return (
        _expanded(found.repartition("key"))
        .sortWithinPartitions("key", "digest")
        .mapInArrow(_compare, _PLACES_SQL)
    )


# ---- removal ------------------------------------------------------------------------------


def _kept(body: bytes, places: np.ndarray, size: int) -> tuple[int, int, bytes]:
    """(words, words removed, kept words joined by one space)."""
    words = body.split()
    if not len(places):
        return len(words), 0, b" ".join(words)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, places, 1)
    np.add.at(edges, places + size, -1)
    gone = np.cumsum(edges[:-1]) > 0
    kept = [w for w, g in zip(words, gone.tolist()) if not g]
    return len(words), int(gone.sum()), b" ".join(kept)


_RESULT = ("n_words long", "n_removed long", "kept string")


def _outcome(body: bytes, places: np.ndarray, size: int, digests: bool) -> tuple:
    n, removed, kept = _kept(body, places, size)
    if digests:
        return n, removed, hashlib.sha256(kept).hexdigest()
    return n, removed, (kept if removed else body).decode()


def _prepared(size: int, digests: bool):
    """Documents as rows for the last shuffle; those settled in their batch carry a result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = [v or b"" for v in batch.column(1).to_pylist()]
            digest = [xxhash.xxh3_128_intdigest(b) for b in bodies]
            copies: dict[int, int] = {}
            for d in digest:
                copies[d] = copies.get(d, 0) + 1
            done: dict[int, tuple] = {}
            results: list[tuple] = []
            for body, d in zip(bodies, digest):
                if copies[d] == 1:
                    n = len(body.split())
                    short = n < size
                    results.append(_outcome(body, (), size, digests) if short else (None,) * 3)
                else:
                    if d not in done:
                        n = len(body.split())
                        done[d] = _outcome(body, np.arange(max(0, n - size + 1)), size, digests)
                    results.append(done[d])
            hi, lo = _halves(digest).T
            pack = zstandard.ZstdCompressor(level=3).compress
            settled = np.array([r[0] is not None for r in results], bool)
            # Settled rows need no partner: they spread by the row instead of the text.
            spread = np.arange(len(digest)) * 0x9E3779B97F4A7C1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.where(settled, spread, hi), pa.int64()),
                    pa.array(np.where(settled, -spread, lo), pa.int64()),
                    batch.column(0),
                    pa.array([None if s else pack(b) for s, b in zip(settled, bodies)], pa.binary()),
                    *[
                        pa.array([r[i] for r in results], t)
                        for i, t in enumerate((pa.int64(), pa.int64(), pa.string()))
                    ],
                ],
                names=["text_hi", "text_lo", "doc_id", "body", "n_words", "n_removed", "kept"],
            )

    return run


def _apply(size: int, digests: bool, key: pa.DataType):
    """Rows sorted by text, places before documents; holds the places of one text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts, unpack = None, [], zstandard.ZstdDecompressor().decompress
        for batch in batches:
            hi, lo, kind, many, ids, bodies, words, removed, kept = (
                c.to_pylist() for c in batch.columns
            )
            out: list[tuple] = []
            for i in range(batch.num_rows):
                if kind[i] == 0:
                    if current != (hi[i], lo[i]):
                        current, parts = (hi[i], lo[i]), []
                    parts.append(np.array(many[i], np.int32))
                elif words[i] is not None:
                    out.append((ids[i], words[i], removed[i], kept[i]))
                else:
                    own = parts if current == (hi[i], lo[i]) else []
                    places = np.unique(np.concatenate(own)) if own else ()
                    out.append((ids[i], *_outcome(unpack(bodies[i]), places, size, digests)))
            columns = list(zip(*out)) if out else [()] * 4
            types = (key, pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                names=["doc_id", "n_words", "n_removed", "kept"],
            )

    return run


def remove_repeated(
    docs: DataFrame, size: int = WINDOW, *, digests: bool = False, cells: int | None = None
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): the words no repeated window covers.

    ``kept`` is the text itself if nothing is removed, else the kept words joined by single
    spaces; with ``digests`` it is the SHA-256 of the joined words in either case.
    """
    key = docs.schema["doc_id"].dataType
    places = repeated_places(docs, size, cells).select(
        "text_hi", "text_lo", F.lit(0).alias("kind"), "many",
        F.lit(None).cast(key).alias("doc_id"), F.lit(None).cast("binary").alias("body"),
        *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in _RESULT],
    )
    schema = f"text_hi long, text_lo long, doc_id {key.simpleString()}, body binary, {', '.join(_RESULT)}"
    rows = text_bytes(docs, "doc_id").mapInArrow(_prepared(size, digests), schema)
    rows = rows.select(
        "text_hi", "text_lo", F.lit(1).alias("kind"),
        F.lit(None).cast("array<int>").alias("many"), "doc_id", "body", "n_words", "n_removed", "kept",
    )
    return (
        places.unionByName(rows)
        .repartition("text_hi", "text_lo")
        .sortWithinPartitions("text_hi", "text_lo", "kind")
        .mapInArrow(
            _apply(size, digests, to_arrow_type(key)),
            f"doc_id {key.simpleString()}, {', '.join(_RESULT)}",
        )
    )


def cut_repeated(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """The documents with repeated passages cut out of ``text``; other columns as they are."""
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*others).alias("doc_id"), "text")
    found = remove_repeated(rows, size)
    return found.select("doc_id.*", F.col("kept").alias("text")).select(*docs.columns)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeated(table(spark, sf_dir, "documents"), digests=True)
    return found.withColumnRenamed("kept", "kept_sha256")
