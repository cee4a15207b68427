"""Cleaning raw transactions into unit lines.

Spark 4 runs with ANSI mode on: a plain cast of ``''`` or a parse of
``2013-13-01`` fails the job, where the reference (Spark 3.5) produced
null.  Every conversion here uses ``try_cast`` / ``try_to_date``, so bad
values become null and are handled by the rules below.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DATE_FORMAT = "yyyy-MM-dd"


@dataclass(frozen=True)
class CleanRules:
    """Optional validity rules (all off by default, as in the reference's code)."""
    product_range: tuple[int, int] | None = None
    require_date: bool = False
    dedup_raw: bool = False


def drop_headers(raw: DataFrame, col: str = "ID_Tienda") -> DataFrame:
    """B1: a stray header line parses to a null store id; drop it."""
    return raw.where(F.col(col).isNotNull())


def explode_units(raw: DataFrame, col: str = "ID_Productos_Raw", sep: str = " ",
                  out: str = "ID_Producto") -> DataFrame:
    """B2: one row per token of the product string, repeats kept ("5 12 5" -> 5, 12, 5)."""
    return raw.withColumn(out, F.explode(F.split(F.col(col), sep))).drop(col)


def cast_lines(lines: DataFrame, product: str = "ID_Producto", date: str = "Fecha",
               product_type: str = "bigint") -> DataFrame:
    """Product to integer and date from ``yyyy-MM-dd``; invalid -> null."""
    return lines.withColumns({
        product: F.col(product).try_cast(product_type),
        date: F.try_to_date(F.col(date), DATE_FORMAT),
    })


def clean_lines(raw: DataFrame, rules: CleanRules | None = None, col: str = "ID_Productos_Raw") -> DataFrame:
    """B1-B5 (+B8): raw transaction rows -> typed unit lines.

    Output columns: Fecha date, ID_Tienda, ID_Transaccion, ID_Producto.
    """
    rules = rules or CleanRules()
    df = drop_headers(raw)
    if rules.dedup_raw:
        df = df.dropDuplicates(["Fecha", "ID_Tienda", "ID_Transaccion", col])
    lines = cast_lines(explode_units(df, col))
    lines = lines.dropna(subset=["ID_Producto"])
    if rules.product_range is not None:
        lo, hi = rules.product_range
        lines = lines.where(F.col("ID_Producto").between(lo, hi))
    if rules.require_date:
        lines = lines.dropna(subset=["Fecha"])
    return lines.select("Fecha", "ID_Tienda", "ID_Transaccion", "ID_Producto")


def union_stores(*frames: DataFrame) -> DataFrame:
    """A4/G1: union all of per-store frames by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
