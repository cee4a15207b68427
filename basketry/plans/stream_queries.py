"""Registered incremental-ingest queries.

Each query writes the raw files in two drops, runs the streaming job after
each drop with ``availableNow`` on one checkpoint, and returns what the sink
holds.  The result must equal the batch result over the whole data, which the
oracle SQL computes.  ``stream_ingest`` cuts by date; the counting queries cut
inside baskets (odd products first), so that a basket's lines come in two
files; ``stream_dedup`` holds back some old transactions, then delivers them
for the first time together with all the others once more.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from basketry.plans.basket_queries import _mining_sql
from basketry.plans.facts import sales, sales_by_basket
from basketry.plans.registry import register, with_sales
from basketry.plans.session import fresh_path
from basketry.sources import tables as tb
from basketry.sources import text as tx
from basketry.streaming import ingest as st

SPLIT_DATE = "1998-01-01"
LATE_MODULO = 7  # every seventh transaction is delivered late


def _drops(spark, sf):
    lines = sales(spark, sf).select("Fecha", "ID_Tienda", "ID_Transaccion", "ID_Producto")
    raw = tx.raw_transactions(lines)
    return raw.where(F.col("Fecha") < SPLIT_DATE), raw.where(F.col("Fecha") >= SPLIT_DATE), raw


def _split_baskets(spark, sf):
    lines = sales_by_basket(spark, sf).select("Fecha", "ID_Tienda", "ID_Transaccion", "ID_Producto")  # no shuffle by basket
    odd = F.pmod(F.col("ID_Producto"), F.lit(2)) == 1
    return tx.raw_transactions(lines.where(odd)), tx.raw_transactions(lines.where(~odd))


def _two_drops(spark, sf, run, first=None, second=None):
    root = fresh_path(spark, "stream")
    a, b, _ = _drops(spark, sf)
    first = a if first is None else first
    second = b if second is None else second
    tx.write_pipe(first, f"{root}/in")
    run(root)
    tx.write_pipe(second, f"{root}/in", mode="append")
    run(root)
    return root


@register("stream_ingest", with_sales(select=f"SELECT {', '.join(tb.SALES_COLUMNS)} FROM sales"), "A13 S1")
def stream_ingest(spark, sf):
    pc, cats = tb.product_category(spark, sf), tb.categories(spark, sf)
    root = _two_drops(spark, sf, lambda r: st.ingest(spark, f"{r}/in", f"{r}/out", f"{r}/ckpt", pc, cats))
    return spark.read.parquet(f"{root}/out")


@register("stream_daily", with_sales(select="""
SELECT Fecha, count(*) AS Total_Productos_Vendidos, count(DISTINCT (ID_Tienda, ID_Transaccion)) AS Numero_Transacciones
FROM sales GROUP BY Fecha"""), "S2")
def stream_daily(spark, sf):
    a, b = _split_baskets(spark, sf)
    root = _two_drops(spark, sf, lambda r: st.merge_daily(spark, f"{r}/in", f"{r}/state", f"{r}/ckpt"), a, b)
    return st.read_daily(spark, f"{root}/state")


@register("stream_pair_counts", _mining_sql(select="""
SELECT x.item AS Item_A, y.item AS Item_B, count(*) AS Transacciones FROM bb x JOIN bb y
  ON x.ID_Tienda = y.ID_Tienda AND x.ID_Transaccion = y.ID_Transaccion AND x.item < y.item GROUP BY 1, 2
HAVING count(*) >= 2"""),
          "S3 K13")
def stream_pair_counts(spark, sf):
    items = tb.read_table(spark, sf, "part").select(F.col("p_partkey").alias("ID_Producto"),
                                                    F.col("p_brand").alias("Item"))
    a, b = _split_baskets(spark, sf)
    root = _two_drops(spark, sf, lambda r: st.merge_pairs(spark, f"{r}/in", f"{r}/state", f"{r}/ckpt", items), a, b)
    return st.read_pairs(spark, f"{root}/state")


@register("stream_dedup", with_sales(select="""
SELECT DISTINCT ID_Tienda, ID_Transaccion, strftime(Fecha, '%Y-%m-%d') AS Fecha FROM sales"""), "S4")
def stream_dedup(spark, sf):
    _, _, raw = _drops(spark, sf)
    late = F.pmod(F.col("ID_Transaccion"), F.lit(LATE_MODULO)) == 0
    root = _two_drops(spark, sf, lambda r: st.dedup_to(spark, f"{r}/in", f"{r}/out", f"{r}/ckpt"),
                      first=raw.where(~late), second=raw)
    return spark.read.parquet(f"{root}/out").select("ID_Tienda", "ID_Transaccion", "Fecha")
