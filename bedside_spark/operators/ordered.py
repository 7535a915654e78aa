"""Ordered per-key calculations that stay parallel when one key is hot.

A plain ``over(partitionBy(key).orderBy(time))`` puts a whole key in one task. Here keys
with more than ``hot_rows`` rows are cut into time slices of about that many rows, the
window runs per (key, slice), and what a slice needs from its neighbours is added:

* row frames get copies of the few rows next to the slice edge (:func:`with_neighbours`);
* running aggregates get the total of the earlier slices (:func:`running`).

Other keys have a NULL slice, i.e. one group and no extra rows, so without hot keys the
plan does the work of the plain window. At most ``rows / hot_rows`` keys can be hot, with
together at most twice as many slices, which bounds everything broadcast here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bedside_spark.functions.timekit import micros

HOT_ROWS = 8_000_000
SLICE = "_slice"
OWN = "_own"
_PARTS = 64


def with_slices(df: DataFrame, key: str, time: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add the slice number: NULL for ordinary keys, 0, 1, 2, … in time order for hot ones.

    A hot key's times are cut at its 64-quantiles, so bursts and stray timestamps do not
    unbalance the slices; larger keys cut each part further into equal spans. A key gets
    about ``rows / hot_rows`` slices. Quantiles are computed for hot keys only.
    """
    at = micros(time)
    counts = (
        df.groupBy(F.col(key).alias("_hot_key"))
        .agg(F.count("*").alias("_rows"))
        .where(F.col("_rows") > hot_rows)
    )
    shares = F.array(*[F.lit(n / _PARTS) for n in range(_PARTS + 1)])
    hot = (
        df.select(F.col(key).alias("_key"), at.alias("_at"))
        .join(F.broadcast(counts), F.col("_key") == F.col("_hot_key"))
        .groupBy("_hot_key")
        .agg(
            F.percentile_approx("_at", shares, 10_000).alias("_cuts"),
            F.ceil(F.first("_rows") / F.lit(float(hot_rows))).alias("_slices"),
        )
    )
    below = F.size(F.filter("_cuts", lambda cut: cut <= F.col("_at")))
    part = F.greatest(F.lit(0), F.least(F.lit(_PARTS - 1), below - 1))
    low, high = F.get("_cuts", F.col("_part")), F.get("_cuts", F.col("_part") + 1)
    spans = F.ceil(F.col("_slices") / F.lit(float(_PARTS)))
    inside = F.floor((F.col("_at") - low).cast("double") * spans / F.greatest(high - low, F.lit(1)))
    inside = F.greatest(F.lit(0), F.least(spans - 1, inside))
    grouped = F.floor(F.col("_part") * F.col("_slices") / F.lit(float(_PARTS)))
    number = F.when(F.col("_slices") <= _PARTS, grouped).otherwise(
        F.col("_part") * spans + inside
    )
    return (
        df.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
        .withColumn("_at", at)
        .withColumn("_part", F.when(F.col("_hot_key").isNotNull(), part))
        .withColumn(SLICE, F.when(F.col("_hot_key").isNotNull(), number))
        .drop("_hot_key", "_cuts", "_slices", "_at", "_part")
    )


def _edge_copies(df: DataFrame, key: str, order: Sequence[str], rows: int, earlier: bool):
    """Copies of each slice's edge rows, relabelled with every slice they must be seen from."""
    onward = [F.col(c).asc() if earlier else F.col(c).desc() for c in order]
    inward = [F.col(c).desc() if earlier else F.col(c).asc() for c in order]
    edge = Window.partitionBy(key, SLICE).orderBy(*inward)
    edges = (
        df.where(F.col(SLICE).isNotNull())
        .withColumn("_nth", F.row_number().over(edge))
        .where(F.col("_nth") <= rows)
        .drop("_nth")
    )
    # Rows here: `rows` per slice of a hot key, not the key's own rows.
    along = Window.partitionBy(key).orderBy(*onward)
    seen_from = F.array_distinct(
        F.array(*[F.lead(SLICE, n).over(along) for n in range(1, rows + 1)])
    )
    return (
        edges.withColumn("_seen", seen_from)
        .withColumn("_target", F.explode("_seen"))
        .where(F.col("_target").isNotNull() & (F.col("_target") != F.col(SLICE)))
        .withColumn(SLICE, F.col("_target"))
        .drop("_seen", "_target")
        .withColumn(OWN, F.lit(False))
    )


def with_neighbours(
    df: DataFrame, key: str, order: Sequence[str], before: int = 0, after: int = 0
) -> DataFrame:
    """Add to each slice the ``before`` rows ahead of it and the ``after`` rows behind it."""
    out = df.withColumn(OWN, F.lit(True))
    if before:
        out = out.unionByName(_edge_copies(df, key, order, before, earlier=True))
    if after:
        out = out.unionByName(_edge_copies(df, key, order, after, earlier=False))
    return out


def own_rows(df: DataFrame) -> DataFrame:
    return df.where(OWN).drop(OWN)


def slice_window(key: str, order: Sequence[str]) -> Window:
    return Window.partitionBy(key, SLICE).orderBy(*order)


def running(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    columns: dict[str, tuple[str, Column]],
    *,
    peers: bool = False,
    last: int = 0,
) -> DataFrame:
    """Running "sum" / "max" columns from the key's first row, for sliced input.

    ``last=-1`` leaves the current row out; ``peers=True`` takes in every row with the
    same order value (``RANGE``). Carries are one row per slice of a hot key.
    """
    combine = {"sum": F.sum, "max": F.max}
    ordered = slice_window(key, order)
    frame = (
        ordered.rangeBetween(Window.unboundedPreceding, Window.currentRow)
        if peers
        else ordered.rowsBetween(Window.unboundedPreceding, last)
    )
    carries = (
        df.where(F.col(SLICE).isNotNull())
        .groupBy(F.col(key).alias("_carry_key"), F.col(SLICE).alias("_carry_slice"))
        .agg(*[combine[kind](col).alias(name) for name, (kind, col) in columns.items()])
    )
    earlier = Window.partitionBy("_carry_key").orderBy("_carry_slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carries = carries.select(
        "_carry_key",
        "_carry_slice",
        *[
            combine[kind](name).over(earlier).alias(f"_carry_{name}")
            for name, (kind, _) in columns.items()
        ],
    )
    local = df.select(
        "*",
        *[combine[kind](col).over(frame).alias(name) for name, (kind, col) in columns.items()],
    )
    joined = local.join(
        F.broadcast(carries),
        (F.col(key) == F.col("_carry_key")) & (F.col(SLICE) == F.col("_carry_slice")),
        "left",
    )
    merged = {}
    for name, (kind, _) in columns.items():
        carry = F.col(f"_carry_{name}")
        both = F.col(name) + carry if kind == "sum" else F.greatest(F.col(name), carry)
        merged[name] = F.coalesce(both, F.col(name), carry)
    return joined.select(*df.columns, *[col.alias(name) for name, col in merged.items()])


#: Bins of values in each doubling of their size.
_BINS = 4096


def value_bin(value: Column) -> Column:
    """A number that never falls as a value rises, the same for neighbours within 1 / 4096.

    Values of one bin lie together in the order, and however many values a key has, a doubling of
    their size has at most ``_BINS`` bins. Unknown values have none.
    """
    size = F.abs(value.cast("double"))
    # Doubles lie between 2^-1075 and 2^1024.
    level = F.floor((F.log2(size) + 1080) * _BINS).cast("bigint")
    special = F.when(F.isnan(value.cast("double")) | (size == F.lit(float("inf"))), F.lit(1 << 40))
    level = F.when(size == 0, F.lit(0)).otherwise(F.coalesce(special, level))
    return F.when(value.cast("double") < 0, -level).otherwise(level)


def distinct_ranks(df: DataFrame, value: str, by: Sequence[str] = (), descending: bool = True):
    """RANK and DENSE_RANK per distinct value, from counts instead of rows.

    The counting aggregate shrinks on the map side. A key's distinct values are ordered bin by bin
    (:func:`value_bin`), and what the bins ahead hold is added, so a task orders the values of one
    bin, or the bins of one key, but never all values of a key.
    """

    def order(column: str) -> Column:
        return F.col(column).desc_nulls_last() if descending else F.col(column).asc_nulls_last()

    counts = df.groupBy(*by, value).agg(F.count("*").alias("_rows"))
    counts = counts.withColumn("_bin", value_bin(F.col(value)))
    bins = counts.groupBy(*by, "_bin").agg(
        F.sum("_rows").alias("_bin_rows"), F.count("*").alias("_bin_values")
    )
    before = Window.partitionBy(*by).orderBy(order("_bin")).rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select(
        *[F.col(c).alias(f"_of_{c}") for c in by],
        F.col("_bin").alias("_of_bin"),
        F.coalesce(F.sum("_bin_rows").over(before), F.lit(0)).alias("_rows_ahead"),
        F.coalesce(F.sum("_bin_values").over(before), F.lit(0)).alias("_values_ahead"),
    )
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by]
    same.append(F.col("_bin").eqNullSafe(F.col("_of_bin")))
    inside = Window.partitionBy(*by, "_bin").orderBy(order(value))
    ahead = inside.rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.withColumns({
        "_here": F.coalesce(F.sum("_rows").over(ahead), F.lit(0)),
        "_nth": F.row_number().over(inside),
    }).join(bins, same)
    return ranked.select(
        *by,
        value,
        (F.col("_rows_ahead") + F.col("_here") + 1).cast("bigint").alias("_rank"),
        (F.col("_values_ahead") + F.col("_nth")).cast("bigint").alias("_dense_rank"),
    )
