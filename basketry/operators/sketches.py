"""Distinct counts of any slice from mergeable sketches.

An exact distinct count of a slice has to read the slice: distinct products of a
range of dates are no sum of the distinct products of its days.  HyperLogLog
sketches can be merged, so one small row a (day, store) answers every range of
dates and stores: units as an exact sum, distinct products, baskets and
categories by the union of the rows' sketches.

A (store, transaction) pair lies in one store, but its units may be spread over
days, so baskets are sketched as well and not summed.

Error: a sketch of 2^p registers has a relative standard error of at most
1.04 / sqrt(2^p), also after any number of unions; ``bound`` is three of them
(99.7 %).  Small counts (below about a tenth of the registers) are exact up to
hash collisions.  Rows: at most days x stores, each of at most 2^p bytes a sketch.

Cases: nulls are not counted, as in COUNT(DISTINCT); a slice without rows has
counts of 0; an empty fact gives an empty table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: log2 of the registers of a sketch
PRECISION = 12
SKETCHES = ("Productos", "Categorias", "Transacciones")


def bound(precision: int = PRECISION, sigmas: float = 3.0) -> float:
    """Relative error that an estimate keeps within ``sigmas`` standard errors."""
    return sigmas * 1.04 / math.sqrt(2.0 ** precision)


def daily_sketches(sales: DataFrame, precision: int = PRECISION) -> DataFrame:
    """One row a (Fecha, ID_Tienda): Unidades (exact) and a sketch per entry of ``SKETCHES``.

    One grouping of the fact with map-side partial sketches; a hot day of a store
    shuffles one row a task.
    """
    basket = F.xxhash64("ID_Tienda", "ID_Transaccion")
    return sales.groupBy("Fecha", "ID_Tienda").agg(
        F.count(F.lit(1)).alias("Unidades"),
        F.hll_sketch_agg(F.col("ID_Producto").cast("bigint"), F.lit(precision)).alias("Productos"),
        F.hll_sketch_agg("Nombre_Categoria", F.lit(precision)).alias("Categorias"),
        F.hll_sketch_agg(basket, F.lit(precision)).alias("Transacciones"))


def merged(daily: DataFrame, *keys: str | Column) -> DataFrame:
    """Rows of ``daily`` (filtered as one likes) rolled up to ``keys``: the same columns, sketches united."""
    return daily.groupBy(*keys).agg(
        F.sum("Unidades").alias("Unidades"), *[F.hll_union_agg(c).alias(c) for c in SKETCHES])


def estimates(rolled: DataFrame, *keys: str) -> DataFrame:
    """The counts behind the sketches of ``merged``: Unidades exact, the rest estimated (bigint)."""
    return rolled.select(*keys, F.coalesce("Unidades", F.lit(0)).alias("Unidades"),
                         *[F.coalesce(F.hll_sketch_estimate(c), F.lit(0)).cast("bigint").alias(c) for c in SKETCHES])


def kpi_of(daily: DataFrame, stores=None, start: str | None = None, end: str | None = None) -> DataFrame:
    """D1 + B9 for a slice by store and date (inclusive), one row, from the small table alone."""
    cond = F.lit(True)
    if stores is not None:
        cond = cond & F.col("ID_Tienda").isin(list(stores))
    if start is not None:
        cond = cond & (F.col("Fecha") >= F.lit(start).cast("date"))
    if end is not None:
        cond = cond & (F.col("Fecha") <= F.lit(end).cast("date"))
    return estimates(merged(daily.where(cond)))


def within(estimate: Column, exact: Column, precision: int = PRECISION) -> Column:
    """True if ``estimate`` keeps the bound (a count of slack of one for tiny sets)."""
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), exact * F.lit(bound(precision)))
