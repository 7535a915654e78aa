"""The two roundings of the engine: SQL results, and normalised measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def rounded(col: Column | str, digits: int) -> Column:
    """SQL ``round`` on doubles: scale, round half away from zero, scale back.

    Spark's own ``round`` works on the decimal text instead, so 51.349999999999994 gives
    51.3 where scaling gives 51.4.
    """
    col = F.col(col) if isinstance(col, str) else col
    factor = F.lit(float(10**digits))
    return F.signum(col) * (F.floor(F.abs(col) * factor + 0.5) / factor)


# A 26-bit split of a double: both halves times a small integer stay exact.
_SPLITTER = 134217729.0
_EXACT_LIMIT = 1e11


def round_exact(col: Column, digits: int = 3) -> Column:
    """Round like a correctly rounded decimal conversion.

    Spark's ``round`` goes through the shortest decimal text, so 2.6755 becomes 2.676
    although the stored double is below the midpoint. Here the sign of ``x - midpoint``
    is computed exactly from the two halves of ``x``.
    """
    scale = 10**digits
    spread = col * F.lit(_SPLITTER)
    high = spread - (spread - col)
    low = col - high
    below = F.floor(col * F.lit(float(scale))).cast("double")
    midpoint = below * 2 + 1
    side = (high * F.lit(2.0 * scale) - midpoint) + low * F.lit(2.0 * scale)
    step = (
        F.when(side > 0, F.lit(1.0))
        .when(side < 0, F.lit(0.0))
        .otherwise(F.abs(F.pmod(below, F.lit(2.0))))
    )
    return F.when(F.abs(col) < _EXACT_LIMIT, (below + step) / F.lit(float(scale))).otherwise(col)
