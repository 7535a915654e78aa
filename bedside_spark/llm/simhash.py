"""SimHash near-duplicates by multi-index hashing of 64-bit fingerprints.

A fingerprint has two 32-bit segments. Two fingerprints that differ in at most three bits agree
in one of them up to one bit, so each fingerprint looks up the 33 values of the Hamming ball of
radius one around either segment in a table of segments, and complete distances of what it
finds are verified. Texts with equal fingerprints meet once, as one fingerprint. A segment value
of more than ``BUCKET`` fingerprints is looked up by a finer table, which adds one of the two
halves of the other segment; by the same argument one of these agrees up to one bit. Nothing is
left out there, and fewer than 700 fingerprints can fit one lookup of it.

Defined results: a null or empty text has fingerprint zero and is linked like any other; ids may
be null or repeated (rows are told apart by fingerprint, and a component's id is the smallest
id that is not null, null if there is none); further columns are not read; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bedside_spark.llm.components import stars
from bedside_spark.llm.frames import checkpointed, table

SHINGLE = 3
MAX_BITS = 3
SEED = 42
BUCKET = 64
#: Rows (16 bytes each) that may be broadcast.
BROADCAST_ROWS = 1_000_000
_FOLD = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Shingles whose bits are counted at once.
_CHUNK = 1 << 16


def fingerprint(body: bytes | None) -> int:
    """SimHash of 3-word shingles, repeats counted; as a signed 64-bit integer."""
    words = (body or b"").translate(_FOLD).split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    last = max(1, len(words) - SHINGLE + 1)
    begin, stop = starts[:last].tolist(), ends[min(SHINGLE, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, last, _CHUNK):
        spans = zip(begin[at : at + _CHUNK], stop[at : at + _CHUNK])
        hashes = np.array([digest(line[a:b], SEED) for a, b in spans], np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8), bitorder="little")
        counts += bits.reshape(-1, 64).sum(axis=0, dtype=np.int32)
    packed = np.packbits(counts * 2 > last, bitorder="little")
    return int(packed.view("<i8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [fingerprint(v.as_py()) for v in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:2], pa.array(values, pa.int64())], names=["doc_id", "text_hash", "fp"]
        )


def _text_hash():
    return F.xxhash64(F.coalesce("text", F.lit("")))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp) of every document's whole text."""
    key = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", _text_hash().alias("text_hash"), F.col("text").cast("binary"))
    return rows.mapInArrow(_fingerprints, f"doc_id {key}, text_hash long, fp long")


def _ball(value, width: int) -> list:
    """``value`` and all values one bit away, over the lowest ``width`` bits."""
    return [value] + [value.bitwiseXOR(F.lit(1 << bit)) for bit in range(width)]


def _segments():
    """Key and rest of both 32-bit segments; bit 32 of the key tells which segment it is."""
    fp, low = F.col("fp"), (1 << 32) - 1
    high, bottom = F.shiftrightunsigned(fp, 32), fp.bitwiseAND(F.lit(low))
    return [(high, bottom), (bottom.bitwiseOR(F.lit(1 << 32)), high)]


def _halves():
    """Both 16-bit halves of ``rest``; bit 16 tells which half it is."""
    rest = F.col("rest")
    top = F.shiftrightunsigned(rest, 16)
    return [top, rest.bitwiseAND(F.lit(0xFFFF)).bitwiseOR(F.lit(1 << 16))]


def _entries(fps: DataFrame, *, ball: bool) -> DataFrame:
    """(fp, key, rest) of the table of segments, or of the lookups in it."""
    rows = [
        F.struct(k.alias("key"), rest.alias("rest"))
        for key, rest in _segments()
        for k in (_ball(key, 32) if ball else [key])
    ]
    return fps.select("fp", F.explode(F.array(*rows)).alias("at")).select("fp", "at.*")


def _finer(entries: DataFrame, *, ball: bool) -> DataFrame:
    halves = [h for half in _halves() for h in (_ball(half, 16) if ball else [half])]
    return entries.select("fp", "key", F.explode(F.array(*halves)).alias("half"))


def links(fps: DataFrame) -> DataFrame:
    """(u, v): all pairs u > v of distinct fingerprints at most ``MAX_BITS`` bits apart."""
    entries, lookups = _entries(fps, ball=False), _entries(fps, ball=True)
    crowded = checkpointed(
        entries.groupBy("key").count().where(F.col("count") > BUCKET).select("key")
    )

    def matches(found: DataFrame) -> DataFrame:
        near = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= MAX_BITS
        return found.where((F.col("fp") > F.col("other")) & near).select(
            F.col("fp").alias("u"), F.col("other").alias("v")
        )

    def other(frame: DataFrame) -> DataFrame:
        return frame.withColumnRenamed("fp", "other").drop("rest")

    sparse = entries.join(crowded, "key", "left_anti")
    found = matches(lookups.drop("rest").join(other(sparse), "key"))
    if not crowded.isEmpty():
        dense = _finer(entries.join(crowded, "key", "left_semi"), ball=False)
        sought = _finer(lookups.join(crowded, "key", "left_semi"), ball=True)
        found = found.unionByName(matches(sought.join(other(dense), ["key", "half"])))
    return found


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) of every document.

    ``root`` is the smallest fingerprint of the component, which names it even without ids.
    """
    marked = checkpointed(fingerprints(docs))
    fps = checkpointed(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    tree = stars(links(fps.select("fp")))
    rooted = checkpointed(
        fps.join(tree, fps.fp == tree.u, "left").select(
            "fp", "first_id", F.coalesce("v", "fp").alias("root")
        )
    )
    least = checkpointed(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")))
    named = rooted.join(least, "root").select("fp", "root", "component_id")
    return marked.join(named, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def one_per_group(docs: DataFrame) -> DataFrame:
    """One document of each component, with its columns as they are.

    The one with the smallest id stays (without ids, or for equal ids, the smallest text hash);
    of equal rows one stays. The list of the others is broadcast up to ``BROADCAST_ROWS`` rows.
    """
    rows = checkpointed(near_duplicates(docs).groupBy("root", "doc_id", "text_hash").count())
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    first = checkpointed(rows.groupBy("root").agg(F.min(rank).alias("head")))
    told = checkpointed(
        rows.join(first, "root").select(
            F.col("doc_id").alias("_told_id"), F.col("text_hash").alias("_told_text"), "count",
            (rank == F.col("head")).alias("stays"),
        )
    )
    same = F.col("doc_id").eqNullSafe(F.col("_told_id")) & (_text_hash() == F.col("_told_text"))

    def listed(wanted: DataFrame) -> DataFrame:
        wanted = wanted.select("_told_id", "_told_text")
        return F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted

    single = docs.join(listed(told.where("not stays or count > 1")), same, "left_anti")
    copies = told.where("stays and count > 1")
    if copies.isEmpty():
        return single
    again = docs.join(listed(copies), same, "left_semi")
    return single.unionByName(again.dropDuplicates(["doc_id", "text"]))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
