"""Catalogue joins.

Category dimension and product map come from a user's files and are joined
without a hint: Spark's size check (``autoBroadcastJoinThreshold``, and AQE at
run time) picks broadcast only while they are small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def catalog(product_category: DataFrame, categories: DataFrame) -> DataFrame:
    """Inner join product -> category id -> category name."""
    return (product_category.join(categories, "ID_Categoria", "inner")
            .select("ID_Producto", "ID_Categoria", "Nombre_Categoria"))


def product_catalog(product_category: DataFrame, categories: DataFrame) -> DataFrame:
    """Product map with names attached, keeping products whose category has no name."""
    return (product_category.join(categories, "ID_Categoria", "left")
            .select("ID_Producto", "ID_Categoria", "Nombre_Categoria"))


def enrich(lines: DataFrame, product_category: DataFrame, categories: DataFrame,
           default: str = "DESCONOCIDA") -> DataFrame:
    """C1 + C2 + B7: lines LEFT JOIN product map LEFT JOIN categories, fill names.

    ``lines LEFT JOIN pc LEFT JOIN cat`` equals ``lines LEFT JOIN (pc LEFT JOIN
    cat)`` because the second key comes from ``pc``; joining the small
    catalogue first means the fact goes through a single join.
    """
    cat = product_catalog(product_category, categories)
    out = lines.join(cat, "ID_Producto", "left")
    return out.fillna({"Nombre_Categoria": default})


def one_category_per_product(sales: DataFrame) -> DataFrame:
    """A single category per product (the smallest name)."""
    return sales.groupBy("ID_Producto").agg(F.min("Nombre_Categoria").alias("Nombre_Categoria"))
