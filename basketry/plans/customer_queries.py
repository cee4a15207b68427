"""Registered customer queries: basket sizes, purchase gaps, RF bands, segments."""

from __future__ import annotations

from basketry.operators import customers as cu
from basketry.plans import facts
from basketry.plans.facts import sales
from basketry.plans.registry import register, with_sales

# Brute force for the oracle: sort every basket by date and difference.
_GAPS_CTE = """gaps AS (SELECT CAST(Fecha_Compra - lag(Fecha_Compra) OVER (ORDER BY Fecha_Compra, ID_Tienda, ID_Transaccion)
      AS INTEGER) AS Dias FROM baskets)"""
_RF_CTE = """rf AS (SELECT ID_Tienda, ID_Transaccion,
      CAST(date_diff('day', max(Fecha), (SELECT max(Fecha) + 1 FROM sales)) AS INTEGER) AS Recencia_Dias,
      count(*) AS Productos_Comprados, count(DISTINCT ID_Producto) AS Productos_Distintos
    FROM sales GROUP BY ID_Tienda, ID_Transaccion)"""
_RF_LABELS_CTE = """lab AS (SELECT *,
      CASE WHEN Recencia_Dias > 0 AND Recencia_Dias <= 30 THEN 'Muy Reciente (<30d)'
           WHEN Recencia_Dias > 30 AND Recencia_Dias <= 60 THEN 'Reciente (30-60d)'
           WHEN Recencia_Dias > 60 AND Recencia_Dias <= 90 THEN 'Moderado (60-90d)'
           WHEN Recencia_Dias > 90 THEN 'Antiguo (>90d)' END AS Recencia_Categoria,
      CASE WHEN Productos_Comprados > 0 AND Productos_Comprados <= 5 THEN 'Baja (1-5)'
           WHEN Productos_Comprados > 5 AND Productos_Comprados <= 15 THEN 'Media (6-15)'
           WHEN Productos_Comprados > 15 AND Productos_Comprados <= 30 THEN 'Alta (16-30)'
           WHEN Productos_Comprados > 30 THEN 'Muy Alta (>30)' END AS Frecuencia_Categoria FROM rf)"""
CROSSTAB_NAMES = ("F_Baja", "F_Media", "F_Alta", "F_Muy_Alta")


@register("basket_size_hist", with_sales(select="""
SELECT Productos_Comprados AS Tamano, count(*) AS Num_Transacciones FROM baskets GROUP BY 1"""), "D22")
def basket_size_hist(spark, sf):
    return cu.basket_size_hist(cu.basket_table(sales(spark, sf)))


@register("monthly_transactions_mean", with_sales(select="""
SELECT count(*) AS Meses, round(avg(n), 6) AS Promedio_Transacciones_Mes
FROM (SELECT strftime(Fecha_Compra, '%Y-%m') AS p, count(*) AS n FROM baskets GROUP BY 1) x"""), "D23")
def monthly_transactions_mean(spark, sf):
    return cu.monthly_baskets(cu.basket_table(sales(spark, sf)))


@register("purchase_gaps", with_sales(_GAPS_CTE, select="""
SELECT Dias, count(*) AS Peso FROM gaps WHERE Dias IS NOT NULL GROUP BY Dias"""), "E5")
def purchase_gaps(spark, sf):
    return cu.purchase_gaps(cu.basket_table(sales(spark, sf)))


@register("purchase_gaps_by_store", with_sales(select="""
SELECT Tienda AS ID_Tienda, Dias, count(*) AS Peso FROM (
  SELECT Tienda, CAST(Fecha_Compra - lag(Fecha_Compra) OVER (PARTITION BY Tienda ORDER BY Fecha_Compra, ID_Transaccion)
         AS INTEGER) AS Dias FROM baskets) g
WHERE Dias IS NOT NULL GROUP BY 1, 2"""), "E5")
def purchase_gaps_by_store(spark, sf):
    """E5 per store in one job (per-date compression partitioned by store)."""
    b = cu.basket_table(sales(spark, sf))
    return cu.purchase_gaps(b, keys=["ID_Tienda"])


@register("purchase_gap_stats", with_sales(_GAPS_CTE, select="""
SELECT count(*) AS Num_Intervalos, round(avg(Dias), 6) AS Media, round(stddev_samp(Dias), 6) AS Desv_Std,
       min(Dias) AS Minimo, max(Dias) AS Maximo,
       round(quantile_cont(Dias, 0.25), 6) AS P25, round(quantile_cont(Dias, 0.5), 6) AS P50,
       round(quantile_cont(Dias, 0.75), 6) AS P75, round(quantile_cont(Dias, 0.9), 6) AS P90
FROM gaps WHERE Dias IS NOT NULL"""), "E6")
def purchase_gap_stats(spark, sf):
    return cu.gap_stats(cu.purchase_gaps(cu.basket_table(sales(spark, sf))))


@register("purchase_gap_ranges", with_sales(
    _GAPS_CTE,
    """r AS (SELECT * FROM (VALUES (0, 'Mismo día (0 días)', 0, 0), (1, '1 día', 1, 1), (2, '2-7 días', 2, 7),
          (3, '8-14 días', 8, 14), (4, '15-30 días', 15, 30), (5, 'Más de 30 días', 31, 1000000000))
          v(Orden, Rango, lo, hi))""",
    select="""SELECT CAST(r.Orden AS INTEGER) AS Orden, r.Rango, CAST(count(g.Dias) AS BIGINT) AS Cantidad,
       round(CAST(count(g.Dias) AS DOUBLE) * 100 / (SELECT count(*) FROM gaps WHERE Dias IS NOT NULL), 6) AS Porcentaje
FROM r LEFT JOIN gaps g ON g.Dias BETWEEN r.lo AND r.hi GROUP BY r.Orden, r.Rango"""), "E7")
def purchase_gap_ranges(spark, sf):
    return cu.gap_ranges(cu.purchase_gaps(cu.basket_table(sales(spark, sf))))


@register("purchase_gap_cdf", with_sales(_GAPS_CTE, select="""
SELECT Dias, Frecuencia, CAST(sum(Frecuencia) OVER (ORDER BY Dias) AS BIGINT) AS Acumulado,
       round(CAST(sum(Frecuencia) OVER (ORDER BY Dias) AS DOUBLE) * 100 / sum(Frecuencia) OVER (), 6)
         AS Porcentaje_Acumulado
FROM (SELECT Dias, count(*) AS Frecuencia FROM gaps WHERE Dias IS NOT NULL GROUP BY Dias) x"""), "E8")
def purchase_gap_cdf(spark, sf):
    return cu.gap_cdf(cu.purchase_gaps(cu.basket_table(sales(spark, sf))))


@register("rf_features", with_sales(_RF_CTE, select="SELECT * FROM rf"), "J1 H6")
def rf_features(spark, sf):
    return cu.rf_features(facts.sales_by_basket(spark, sf), as_of=cu.as_of_date(sales(spark, sf)))


@register("rfm_bands", with_sales(_RF_CTE, _RF_LABELS_CTE, select="""
SELECT 'Recencia' AS Dimension, Recencia_Categoria AS Banda, count(*) AS Num_Transacciones FROM lab GROUP BY 2
UNION ALL
SELECT 'Frecuencia', Frecuencia_Categoria, count(*) FROM lab GROUP BY 2"""), "J2 H12")
def rfm_bands(spark, sf):
    return cu.rfm_bands(cu.rf_features(sales(spark, sf)))


@register("rfm_segments", with_sales(_RF_CTE, _RF_LABELS_CTE, select="""
SELECT coalesce(Recencia_Categoria, 'nan') || ' / ' || coalesce(Frecuencia_Categoria, 'nan') AS Segmento_RFM,
       count(*) AS Num_Transacciones FROM lab GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""), "J3 H13")
def rfm_segments(spark, sf):
    return cu.rfm_segments(cu.rf_features(sales(spark, sf)), 10)


@register("rfm_crosstab", with_sales(_RF_CTE, _RF_LABELS_CTE, select="""
SELECT Recencia_Categoria,
       count(*) FILTER (WHERE Frecuencia_Categoria = 'Baja (1-5)') AS F_Baja,
       count(*) FILTER (WHERE Frecuencia_Categoria = 'Media (6-15)') AS F_Media,
       count(*) FILTER (WHERE Frecuencia_Categoria = 'Alta (16-30)') AS F_Alta,
       count(*) FILTER (WHERE Frecuencia_Categoria = 'Muy Alta (>30)') AS F_Muy_Alta
FROM lab GROUP BY Recencia_Categoria"""), "D21 J4")
def rfm_crosstab(spark, sf):
    lab = cu.rf_labels(cu.rf_features(sales(spark, sf)))
    return cu.crosstab(lab, "Recencia_Categoria", "Frecuencia_Categoria", cu.UNITS_LABELS, CROSSTAB_NAMES)


@register("size_segments", with_sales(select="""
SELECT CASE WHEN Productos_Comprados <= 5 THEN 'Compra Pequeña (1-5 productos)'
            WHEN Productos_Comprados <= 15 THEN 'Compra Media (6-15 productos)'
            WHEN Productos_Comprados <= 30 THEN 'Compra Grande (16-30 productos)'
            ELSE 'Compra Muy Grande (>30 productos)' END AS Segmento_Tamano,
       count(*) AS Total_Transacciones, round(avg(Productos_Comprados), 6) AS Promedio,
       round(quantile_cont(Productos_Comprados, 0.5), 6) AS Mediana,
       min(Productos_Comprados) AS Minimo, max(Productos_Comprados) AS Maximo,
       round(CAST(count(*) AS DOUBLE) * 100 / (SELECT count(*) FROM baskets), 6) AS Porcentaje
FROM baskets GROUP BY 1"""), "J5 H11")
def size_segments(spark, sf):
    return cu.size_segments(cu.basket_table(sales(spark, sf)))
