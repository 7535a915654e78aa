"""Sharding by a Feistel permutation of global row numbers, in DataFrame functions only.

Rows are numbered 0 to N - 1 in the order of a digest of (id, size, checksum), then of these
three. The numbers are permuted by a keyed Feistel network over pairs (number div b, number mod
b) with a * b >= N; a number outside the rows walks on along its cycle until it falls inside. A
row's shard is its permuted number modulo the shard count and its slot the quotient, so the
shuffle is reproducible, shard sizes differ by one row at most, and the place of row n can be
computed.

Numbering needs no global sort: rows are counted by (id, size, checksum) first, so repeated
rows, however many, are one group; the square root of the number of groups gives the number of
buckets, ranges of the digest, in which groups are ordered; offsets come from one row per bucket.

Defined results: a null or empty text has size 16 and checksum 0; a null id is a value of its
own; rows equal in id, size and checksum are interchangeable; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bedside_spark.llm.frames import checkpointed, table

SHARDS = 40
OVERHEAD = 16
ROUNDS = 4
SEED = 20_260_101
#: Copies of a row that are written out from one row of the plan.
COPIES = 100_000
#: Buckets whose offsets (16 bytes each) may be broadcast.
BROADCAST_BUCKETS = 1_000_000
#: Multiplier of the round function; values stay below 2 ** 31 and products below 2 ** 62.
_FACTOR = 1_103_515_245
_HALF = 1 << 31


def sides(n: int) -> tuple[int, int]:
    """a, b with a * b >= n and a * b - n < a."""
    a = max(1, math.isqrt(n))
    return a, max(1, -(-n // a))


def round_keys(seed: int) -> list[int]:
    return [(seed * 2_654_435_761 + 40_503 * (i + 1) ** 2) % _HALF for i in range(2 * ROUNDS)]


def _mixed(value: Column, key: Column) -> Column:
    x = (value * F.lit(_FACTOR) + key) % F.lit(_HALF)
    x = x.bitwiseXOR(F.shiftright(x, 15))
    x = (x * F.lit(_FACTOR) + key) % F.lit(_HALF)
    return x.bitwiseXOR(F.shiftright(x, 13))


def feistel(number: Column, n: int, seed: int = SEED) -> Column:
    """One pass of the network over 0 to a * b - 1."""
    a, b = sides(n)
    keys = F.array(*[F.lit(k).cast("long") for k in round_keys(seed)])
    first = F.struct(
        F.floor(number / F.lit(b)).cast("long").alias("x"),
        F.pmod(number, F.lit(b)).cast("long").alias("y"),
        F.lit(False).alias("turned"),
    )

    def turn(s: Column, key: Column) -> Column:
        # The halves take turns: x moves by y, then y by x, each in its own range.
        size = F.when(s["turned"], F.lit(b)).otherwise(F.lit(a)).cast("long")
        moved = (s["x"] + _mixed(s["y"], key)) % size
        return F.struct(s["y"].alias("x"), moved.alias("y"), (~s["turned"]).alias("turned"))

    return F.aggregate(keys, first, turn, lambda s: s["x"] * F.lit(b) + s["y"])


def permuted(number: Column, n: int, seed: int = SEED) -> Column:
    """A permutation of 0 to n - 1.

    At most ``a * b - n`` numbers lie outside, so that many further steps always suffice.
    """
    once, outside = feistel(number, n, seed), math.prod(sides(n)) - n
    if not outside:
        return once
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(outside)),
        once,
        lambda x, _: F.when(x < n, x).otherwise(feistel(x, n, seed)),
    )
    return F.when(once < n, once).otherwise(walked)


def numbered(rows: DataFrame, *key: str) -> tuple[DataFrame, int]:
    """``key`` columns and ``number``, 0 to N - 1 over all rows, and N."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in key]
    digest = F.md5(F.concat_ws("|", *text))
    groups = checkpointed(rows.groupBy(*key).agg(F.count("*").alias("copies")))
    found = groups.agg(F.count("*"), F.sum("copies"), F.max("copies")).first()
    n_groups, n, most = (value or 0 for value in found)
    buckets = max(1, math.isqrt(n_groups))
    lead = F.conv(F.substring("digest", 1, 8), 16, 10).cast("long")
    placed = groups.withColumn("digest", digest).withColumn(
        "bucket", F.floor(lead * F.lit(buckets) / F.lit(1 << 32)).cast("long")
    )
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("bucket").agg(F.sum("copies").alias("total"))
    offsets = totals.select(
        "bucket", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset")
    )
    inside = Window.partitionBy("bucket").orderBy("digest", *key)
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    ordered = placed.withColumn("start", F.coalesce(F.sum("copies").over(inside), F.lit(0)))
    if buckets <= BROADCAST_BUCKETS:
        offsets = F.broadcast(offsets)
    parts = F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / F.lit(COPIES)).cast("int"))
    spread = ordered.join(offsets, "bucket").select(
        *key, "copies", (F.col("offset") + F.col("start")).alias("start"), F.explode(parts).alias("part")
    )
    if most > COPIES:
        spread = spread.repartition("start", "part")
    skipped = F.col("part").cast("long") * COPIES
    inner = F.sequence(F.lit(0), (F.least(F.lit(COPIES), F.col("copies") - skipped) - 1).cast("int"))
    result = spread.select(*key, (F.col("start") + skipped).alias("start"), F.explode(inner).alias("copy"))
    return result.select(*key, (F.col("start") + F.col("copy")).alias("number")), n


def shards(docs: DataFrame, count: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row, shard sizes at most one apart."""
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(body) + OVERHEAD).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
    )
    listed, n = numbered(rows, "doc_id", "size", "text_crc32")
    place = listed.withColumn("place", permuted(F.col("number"), n, seed))
    return place.select(
        "doc_id",
        "size",
        "text_crc32",
        F.pmod("place", F.lit(count)).cast("int").alias("shard"),
        F.floor(F.col("place") / F.lit(count)).cast("long").alias("slot"),
    )


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
