"""Scalar labelling helpers (H7-H14): right-closed ``cut``, fixed-width
histogram bins, safe ratios.  All are native ``when`` / arithmetic
expressions; none is a Python UDF.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cut(c: Column, bins, labels) -> Column:
    """pandas ``cut`` with right-closed bins: (b0, b1] -> labels[0], ...; outside -> null."""
    if len(labels) != len(bins) - 1:
        raise ValueError("need len(bins) - 1 labels")
    expr = None
    for lo, hi, lab in zip(bins[:-1], bins[1:], labels):
        cond = c > F.lit(lo)
        if not math.isinf(hi):
            cond = cond & (c <= F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def rnd(c, digits: int = 6) -> Column:
    """Round to ``digits`` decimals on the binary value: x * 10^d rounded half away
    from zero, divided back.  This is the convention of most SQL engines;
    Spark's ``round`` instead rounds the shortest decimal form, which differs
    on exact binary ties.  ``round(y, 0)`` is exact for |y| < 2^52.
    """
    c = F.col(c) if isinstance(c, str) else c
    m = float(10 ** digits)
    return F.round(c * F.lit(m), 0) / F.lit(m)


def ratio(num, den, scale: float = 1.0, digits: int | None = None) -> Column:
    """``num / den * scale``; null when ``den`` is 0 or null."""
    r = F.try_divide(F.col(num) if isinstance(num, str) else num,
                     F.col(den) if isinstance(den, str) else den) * F.lit(scale)
    return rnd(r, digits) if digits is not None else r


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Fixed-width histogram over [min, max]; the last bin is closed.

    Bin i covers [min + i*w, min + (i+1)*w); the maximum falls in the last
    bin (numpy convention).  min / max are scalar subqueries.
    """
    lo_q = df.agg(F.min(col).cast("double")).scalar()
    hi_q = df.agg(F.max(col).cast("double")).scalar()
    # each scalar subquery is referenced once, then used by name
    base = df.where(F.col(col).isNotNull()).select(F.col(col).alias("_x"), lo_q.alias("_lo"), hi_q.alias("_hi"))
    lo, hi = F.col("_lo"), F.col("_hi")
    width = F.when(hi == lo, F.lit(0.0)).otherwise((hi - lo) / F.lit(bins))
    raw = F.when(hi == lo, F.lit(0)).otherwise(F.floor((F.col("_x") - lo) / width))
    b = F.least(raw, F.lit(bins - 1)).cast("int")
    counts = base.groupBy(b.alias("Bin"), "_lo", "_hi").agg(F.count(F.lit(1)).alias("Frecuencia"))
    width = F.when(hi == lo, F.lit(0.0)).otherwise((hi - lo) / F.lit(bins))
    return counts.select(
        "Bin",
        rnd(lo + F.col("Bin") * width, 6).alias("Desde"),
        rnd(lo + (F.col("Bin") + 1) * width, 6).alias("Hasta"),
        "Frecuencia")
