"""Registered source, cleaning and enrichment queries.

The driver has no text input, so these queries first write the mapped
columns in the reference's raw formats (pipe CSV, space-separated product
lists, stray header lines, dotted header names) to a fresh folder under
the shared scratch folder, then read them back through the readers and
cleaners, whose output is compared with SQL over the original tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from basketry.functions import calendar as cal
from basketry.operators import clean as cl
from basketry.operators import enrich as en
from basketry.operators import products as pr
from basketry.plans.facts import sales
from basketry.plans.registry import register, with_sales
from basketry.plans.session import fresh_path
from basketry.sources import sinks
from basketry.sources import tables as tb
from basketry.sources import text as tx

RULES = cl.CleanRules(product_range=(1, 1000), require_date=True, dedup_raw=True)

_LINES_SQL = with_sales(select="SELECT Fecha, ID_Tienda, ID_Transaccion, ID_Producto FROM sales")


def _lines(spark, sf):
    return sales(spark, sf).select("Fecha", "ID_Tienda", "ID_Transaccion", "ID_Producto")


def _raw_dir(spark, sf, header=False, trailing_space=False, by_store=False) -> str:
    path = fresh_path(spark, "raw")
    raw = tx.raw_transactions(_lines(spark, sf), trailing_space=trailing_space)
    if by_store:
        tx.write_pipe(raw, path, header=header, partition_by=("ID_Tienda",))
    else:
        tx.write_pipe(raw, path, header=header)
    return path


def _catalog_files(spark, sf) -> tuple[str, str]:
    root = fresh_path(spark, "catalog")
    tx.write_pipe(tb.categories(spark, sf), f"{root}/categories")
    pc = tb.product_category(spark, sf).select(
        F.col("ID_Producto").alias(tx.PRODUCT_CATEGORY_HEADER[0]),
        F.col("ID_Categoria").alias(tx.PRODUCT_CATEGORY_HEADER[1]))
    tx.write_pipe(pc, f"{root}/product_category", header=True)
    return f"{root}/categories", f"{root}/product_category"


@register("src_raw_roundtrip", _LINES_SQL, "A3 B2")
def src_raw_roundtrip(spark, sf):
    raw = tx.read_transactions(spark, f"{_raw_dir(spark, sf)}/*.csv")
    return cl.clean_lines(raw)


@register("clean_lines", _LINES_SQL, "B1 B3 B4 B5")
def clean_lines(spark, sf):
    raw = tx.read_transactions(spark, f"{_raw_dir(spark, sf, header=True, trailing_space=True)}/*.csv")
    return cl.clean_lines(raw)


@register("clean_rules", with_sales(select="""
SELECT Fecha, ID_Tienda, ID_Transaccion, ID_Producto FROM sales WHERE ID_Producto BETWEEN 1 AND 1000"""), "B8")
def clean_rules(spark, sf):
    raw = tx.read_transactions(spark, f"{_raw_dir(spark, sf, header=True)}/*.csv")
    return cl.clean_lines(raw, RULES)


@register("explode_units", with_sales(select="""
SELECT ID_Transaccion, count(*) AS Unidades FROM sales GROUP BY ID_Transaccion"""), "B2")
def explode_units(spark, sf):
    raw = cl.drop_headers(tx.read_transactions(spark, f"{_raw_dir(spark, sf)}/*.csv"))
    return cl.explode_units(raw).groupBy("ID_Transaccion").agg(F.count(F.lit(1)).alias("Unidades"))


@register("union_stores", with_sales(select="""
SELECT ID_Tienda, count(DISTINCT (ID_Tienda, ID_Transaccion)) AS Transacciones, count(*) AS Unidades FROM sales GROUP BY 1"""),
          "A4 G1")
def union_stores(spark, sf):
    raw = tx.read_store_dirs(spark, _raw_dir(spark, sf, by_store=True))
    lines = cl.clean_lines(raw)
    return lines.groupBy("ID_Tienda").agg(F.count_distinct("ID_Transaccion").alias("Transacciones"),
                                          F.count(F.lit(1)).alias("Unidades"))


@register("src_catalog", with_sales(select="SELECT ID_Categoria, Nombre_Categoria FROM cats"), "A1")
def src_catalog(spark, sf):
    cats, _ = _catalog_files(spark, sf)
    return tx.read_categories(spark, cats)


@register("catalog", with_sales(select="SELECT ID_Producto, ID_Categoria, Nombre_Categoria FROM pcat"), "A2 C3")
def catalog(spark, sf):
    cats, pc = _catalog_files(spark, sf)
    return en.catalog(tx.read_product_category(spark, pc), tx.read_categories(spark, cats))


@register("catalog_counts", with_sales(select="""
SELECT Nombre_Categoria, count(*) AS Filas, count(DISTINCT ID_Producto) AS Num_Productos,
       min(ID_Producto) AS Producto_Min, max(ID_Producto) AS Producto_Max,
       round(CAST(count(DISTINCT ID_Producto) AS DOUBLE) * 100 / (SELECT count(DISTINCT ID_Producto) FROM pcat), 6)
         AS Porcentaje
FROM pcat GROUP BY Nombre_Categoria"""), "D19 I12 G3")
def catalog_counts(spark, sf):
    cats = tb.categories(spark, sf)
    return pr.catalog_counts(en.catalog(tb.product_category(spark, sf, cats), cats))


@register("enrich_sales", with_sales(select=f"SELECT {', '.join(tb.SALES_COLUMNS)} FROM sales"), "C1 C2 B7 H1 H5")
def enrich_sales(spark, sf):
    raw = tx.read_transactions(spark, f"{_raw_dir(spark, sf)}/*.csv")
    cats, pc = _catalog_files(spark, sf)
    lines = cl.clean_lines(raw)
    enriched = en.enrich(lines, tx.read_product_category(spark, pc), tx.read_categories(spark, cats),
                         default=tb.UNKNOWN_CATEGORY)
    return cal.sales_calendar(enriched).select(*tb.SALES_COLUMNS)


_EXPORTED = ("ID_Transaccion", "ID_Tienda", "Fecha", "ID_Producto", "Nombre_Categoria", "Anio", "Mes", "DiaSemana", "Hora")


@register("export_roundtrip", with_sales(select=f"SELECT {', '.join(_EXPORTED)} FROM sales"), "A6 A10 A11")
def export_roundtrip(spark, sf):
    """The sales export written as CSV parts over an earlier (empty) export, and read back."""
    df = sales(spark, sf).select(*_EXPORTED)
    root = fresh_path(spark, "export")
    sinks.export_all({"ventas": df.limit(0)}, root)
    path = sinks.export_all({"ventas": df}, root)["ventas"]
    return sinks.read_export(spark, path, df.schema)


@register("stage_roundtrip", with_sales(select="""
SELECT ID_Tienda, ID_Transaccion, ID_Producto, Fecha, Anio, Mes FROM sales"""), "A5 A7 A8 A9 A12 A14")
def stage_roundtrip(spark, sf):
    """Two versions of a partitioned, snappy stage (the first one typed and empty); the older is dropped."""
    df = sales(spark, sf).select("ID_Tienda", "ID_Transaccion", "ID_Producto", "Fecha", "Anio", "Mes")
    root = fresh_path(spark, "stages")
    sinks.write_stage(sinks.empty_frame(spark, df.schema), root, "t")
    sinks.write_stage(df.hint("rebalance", "Anio", "Mes"), root, "t", partition_by=("Anio", "Mes"))
    sinks.retain(spark, root, "t", keep=1)
    return sinks.read_stage(spark, root, "t").select(df.columns)
