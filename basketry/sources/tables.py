"""Driver tables and the ``sales`` fact derived from them.

Retail mapping (one row of ``lineitem`` = one unit sold):

=================  ==============================================
sales column       source
=================  ==============================================
ID_Transaccion     l_orderkey
ID_Tienda          c_nationkey of the order's customer
Fecha              o_orderdate as a date
ID_Producto        l_partkey
ID_Categoria       id of the part's p_type, parts with p_size <= 45
Nombre_Categoria   that p_type, else ``DESCONOCIDA``
Hora               pmod(ID_Transaccion, 24) (the simulated hour)
=================  ==============================================

Join order is chosen for scale: ``orders`` meets ``customer`` first (the
smaller side of the fact), and only then ``lineitem`` on the order key, so
the widest table is shuffled once.  The catalogue (one row per part) joins
the fact on the product key; the category dimension (one row per category
name) is left to Spark's own size check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.functions import calendar as cal
from basketry.operators import enrich as en

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Fixed values of the retail mapping.
CATEGORY_MAX_SIZE = 45
UNKNOWN_CATEGORY = "DESCONOCIDA"

SALES_COLUMNS = ("ID_Categoria", "ID_Producto", "Fecha", "ID_Tienda", "ID_Transaccion",
                 "Nombre_Categoria", "Anio", "Mes", "Dia", "Dia_Semana", "Semana_Anio",
                 "Hora", "HoraDelDia", "DiaSemana", "DiaSemana_L0")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category dimension: one row per part type, ids 1..n in name order.

    The distinct runs as a partial aggregate on every scan task; only the
    distinct names (a handful) reach the numbering window.
    """
    names = read_table(spark, sf_dir, "part").select(F.col("p_type").alias("Nombre_Categoria")).distinct()
    return names.select(
        F.row_number().over(Window.orderBy("Nombre_Categoria")).cast("int").alias("ID_Categoria"),
        "Nombre_Categoria")


def product_category(spark: SparkSession, sf_dir: str, cats: DataFrame | None = None) -> DataFrame:
    """Product -> category id map (parts above the size limit have none)."""
    part = (read_table(spark, sf_dir, "part")
            .where(F.col("p_size") <= CATEGORY_MAX_SIZE)
            .select(F.col("p_partkey").alias("ID_Producto"), F.col("p_type").alias("Nombre_Categoria")))
    cats = categories(spark, sf_dir) if cats is None else cats
    return part.join(cats, "Nombre_Categoria").select("ID_Producto", "ID_Categoria")


def order_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the nation of their customer: ID_Transaccion, ID_Tienda, Fecha."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return (orders.join(cust, orders.o_custkey == cust.c_custkey)
            .select(F.col("o_orderkey").alias("ID_Transaccion"),
                    F.col("c_nationkey").alias("ID_Tienda"),
                    F.to_date("o_orderdate").alias("Fecha")))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean unit lines: ID_Transaccion, ID_Tienda, Fecha, ID_Producto."""
    heads = order_heads(spark, sf_dir)
    lines = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("ID_Transaccion"), F.col("l_partkey").alias("ID_Producto"))
    return lines.join(heads, "ID_Transaccion").select("ID_Transaccion", "ID_Tienda", "Fecha", "ID_Producto")


def order_items(spark: SparkSession, sf_dir: str, item: str) -> DataFrame:
    """Basket key + item per unit line (item = an attribute of the part).  The parts are joined before the heads, so that
    the lines end up side by side by transaction and baskets need no further shuffle, whether the parts are broadcast or not."""
    part = read_table(spark, sf_dir, "part").select(F.col("p_partkey").alias("ID_Producto"), F.col(item).alias("Item"))
    lines = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("ID_Transaccion"), F.col("l_partkey").alias("ID_Producto"))
    return lines.join(part, "ID_Producto").drop("ID_Producto") \
        .join(order_heads(spark, sf_dir).drop("Fecha"), "ID_Transaccion").select("ID_Tienda", "ID_Transaccion", "Item")


def enriched_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit lines with their category (lazy): what the calendar columns are added to."""
    cats = categories(spark, sf_dir)
    return en.enrich(order_lines(spark, sf_dir), product_category(spark, sf_dir, cats), cats, default=UNKNOWN_CATEGORY)


def sales_view(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """The sales fact computed from the driver tables (lazy, no write), or from given ``enriched_lines``."""
    lines = enriched_lines(spark, sf_dir) if lines is None else lines
    return cal.sales_calendar(lines).select(*SALES_COLUMNS)
