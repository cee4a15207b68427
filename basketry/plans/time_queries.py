"""Registered time-series queries: periods, weekday/month, heatmaps, trends."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketry.operators import temporal as tm
from basketry.plans import facts
from basketry.plans.facts import sales
from basketry.plans.registry import register, with_sales

_PERIOD_AGG = """count(*) AS Total_Productos_Vendidos, count(DISTINCT (ID_Tienda, ID_Transaccion)) AS Numero_Transacciones,
       count(DISTINCT ID_Tienda) AS Tiendas_Activas"""
_WEEK_SQL = "CAST(year(Fecha) AS VARCHAR) || '-W' || strftime(Fecha, '%U')"
_DAILY_CTE = f"d AS (SELECT Fecha, {_PERIOD_AGG} FROM sales GROUP BY Fecha)"
_MONTHLY_CTE = f"m AS (SELECT strftime(Fecha, '%Y-%m') AS Periodo, {_PERIOD_AGG} FROM sales GROUP BY 1)"
_WEEKLY_CTE = f"w AS (SELECT {_WEEK_SQL} AS Periodo, {_PERIOD_AGG} FROM sales GROUP BY 1)"
_DAYS_ES = "['Lunes', 'Martes', 'Miércoles', 'Jueves', 'Viernes', 'Sábado', 'Domingo']"
_MONTHS_ES = ("['Enero', 'Febrero', 'Marzo', 'Abril', 'Mayo', 'Junio', 'Julio', 'Agosto', 'Septiembre', "
              "'Octubre', 'Noviembre', 'Diciembre']")
UNUSUAL_K = 2.0


@register("daily_sales", with_sales(_DAILY_CTE, select="SELECT * FROM d"), "D8 D9")
def daily_sales(spark, sf):
    return tm.period_sales(sales(spark, sf), "day")


@register("weekly_sales", with_sales(_WEEKLY_CTE, select="SELECT * FROM w"), "D10 H3")
def weekly_sales(spark, sf):
    return tm.period_sales(sales(spark, sf), "week")


@register("monthly_sales", with_sales(_MONTHLY_CTE, select="SELECT * FROM m"), "D11")
def monthly_sales(spark, sf):
    return tm.period_sales(sales(spark, sf), "month")


@register("sales_by_weekday", with_sales(
    """a AS (SELECT DiaSemana_L0 AS Dia_Num, count(*) AS Total_Productos,
             count(DISTINCT (ID_Tienda, ID_Transaccion)) AS Numero_Transacciones FROM sales GROUP BY 1),
    k AS (SELECT CAST(i AS INTEGER) AS Dia_Num FROM range(7) t(i))""",
    select=f"""SELECT k.Dia_Num, {_DAYS_ES}[k.Dia_Num + 1] AS Dia, coalesce(a.Total_Productos, 0) AS Total_Productos,
       coalesce(a.Numero_Transacciones, 0) AS Numero_Transacciones FROM k LEFT JOIN a USING (Dia_Num)"""),
    "D12 H4")
def sales_by_weekday(spark, sf):
    return tm.by_weekday(sales(spark, sf))


@register("sales_by_month", with_sales(select=f"""
SELECT Mes, count(*) AS Total_Productos, count(DISTINCT (ID_Tienda, ID_Transaccion)) AS Numero_Transacciones,
       {_MONTHS_ES}[Mes] AS Nombre_Mes FROM sales GROUP BY Mes"""), "D16 H4")
def sales_by_month(spark, sf):
    return tm.by_month(sales(spark, sf))


@register("period_extremes", with_sales(
    _DAILY_CTE,
    """wd AS (SELECT DiaSemana_L0 AS k, count(*) AS v FROM sales GROUP BY 1),
    mo AS (SELECT Mes AS k, count(*) AS v FROM sales GROUP BY 1)""",
    select="""
(SELECT 'Dia_Semana' AS Serie, 'MAX' AS Extremo, CAST(k AS VARCHAR) AS Clave, CAST(v AS DOUBLE) AS Valor
   FROM wd ORDER BY v DESC, k LIMIT 1)
UNION ALL (SELECT 'Dia_Semana', 'MIN', CAST(k AS VARCHAR), CAST(v AS DOUBLE) FROM wd ORDER BY v, k LIMIT 1)
UNION ALL (SELECT 'Mes', 'MAX', CAST(k AS VARCHAR), CAST(v AS DOUBLE) FROM mo ORDER BY v DESC, k LIMIT 1)
UNION ALL (SELECT 'Mes', 'MIN', CAST(k AS VARCHAR), CAST(v AS DOUBLE) FROM mo ORDER BY v, k LIMIT 1)
UNION ALL (SELECT 'Fecha', 'MAX', CAST(Fecha AS VARCHAR), CAST(Total_Productos_Vendidos AS DOUBLE) FROM d
           ORDER BY Total_Productos_Vendidos DESC, Fecha LIMIT 1)
UNION ALL (SELECT 'Fecha', 'MIN', CAST(Fecha AS VARCHAR), CAST(Total_Productos_Vendidos AS DOUBLE) FROM d
           ORDER BY Total_Productos_Vendidos, Fecha LIMIT 1)"""), "D13")
def period_extremes(spark, sf):
    s = sales(spark, sf)
    wd = s.groupBy(F.col("DiaSemana_L0").alias("k")).agg(F.count(F.lit(1)).alias("v"))
    mo = s.groupBy(F.col("Mes").alias("k")).agg(F.count(F.lit(1)).alias("v"))
    daily = tm.period_sales(s, "day")
    return (tm.extremes(wd, "k", "v", "Dia_Semana")
            .unionByName(tm.extremes(mo, "k", "v", "Mes"))
            .unionByName(tm.extremes(daily, "Fecha", "Total_Productos_Vendidos", "Fecha")))


@register("heatmap_dow_hour", with_sales(
    """c AS (SELECT DiaSemana, Hora, count(*) AS n FROM sales GROUP BY 1, 2),
    k AS (SELECT CAST(i AS INTEGER) AS DiaSemana FROM range(1, 8) t(i))""",
    select="SELECT k.DiaSemana, " + ", ".join(
        f"CAST(coalesce(sum(CASE WHEN Hora = {h} THEN n END), 0) AS BIGINT) AS H{h:02d}" for h in range(24))
    + " FROM k LEFT JOIN c USING (DiaSemana) GROUP BY k.DiaSemana"), "D14")
def heatmap_dow_hour(spark, sf):
    return tm.heatmap_dow_hour(sales(spark, sf))


@register("heatmap_week_dow", with_sales(select="SELECT Semana_Anio, " + ", ".join(
    f"count(*) FILTER (WHERE DiaSemana_L0 = {d}) AS D{d}" for d in range(7))
    + " FROM sales GROUP BY Semana_Anio"), "D15")
def heatmap_week_dow(spark, sf):
    return tm.heatmap_week_dow(sales(spark, sf))


@register("weekday_peak_hour", with_sales(
    """p AS (SELECT DiaSemana, Hora, count(DISTINCT (ID_Tienda, ID_Transaccion)) AS t FROM sales GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY DiaSemana ORDER BY t DESC, Hora) AS rn,
          sum(t) OVER (PARTITION BY DiaSemana) AS tot FROM p)""",
    select="""SELECT DiaSemana, Hora AS Hora_Pico, t AS Transacciones_Pico, CAST(tot AS BIGINT) AS Transacciones_Dia,
       round(CAST(t AS DOUBLE) * 100 / tot, 6) AS Porcentaje_Pico FROM r WHERE rn = 1"""), "D24")
def weekday_peak_hour(spark, sf):
    return tm.weekday_peak_hour(sales(spark, sf))


@register("weekday_uplift", with_sales(
    "d AS (SELECT Fecha, count(*) AS v FROM sales GROUP BY Fecha)",
    select="""SELECT CAST(dayofweek(Fecha) + 1 AS INTEGER) AS DiaSemana, count(*) AS Dias,
       round(avg(v), 6) AS Promedio_Diario,
       round((round(avg(v), 6) / (SELECT avg(v) FROM d) - 1) * 100, 6) AS Uplift_Pct
FROM d GROUP BY 1"""), "D25")
def weekday_uplift(spark, sf):
    return tm.weekday_uplift(sales(spark, sf))


@register("weekend_hour_profile", with_sales(
    """p AS (SELECT CASE WHEN DiaSemana IN (1, 7) THEN 'Fin de semana' ELSE 'Entre semana' END AS Tipo_Dia, Hora,
          count(*) AS Unidades FROM sales GROUP BY 1, 2)""",
    select="""SELECT Tipo_Dia, Hora, Unidades,
       round(CAST(Unidades AS DOUBLE) * 100.0 / sum(Unidades) OVER (PARTITION BY Tipo_Dia), 6) AS Porcentaje FROM p"""),
    "D25")
def weekend_hour_profile(spark, sf):
    return tm.weekend_hour_profile(sales(spark, sf))


def _summary_sql(label: str, cte: str) -> str:
    return f"""SELECT '{label}' AS Periodo, count(*) AS Num_Periodos, round(avg(Total_Productos_Vendidos), 6) AS Promedio,
       max(Total_Productos_Vendidos) AS Maximo, min(Total_Productos_Vendidos) AS Minimo,
       round(stddev_samp(Total_Productos_Vendidos), 6) AS Desv_Std,
       round(avg(Numero_Transacciones), 6) AS Promedio_Transacciones FROM {cte}"""


@register("period_summary", with_sales(
    _DAILY_CTE, _WEEKLY_CTE, _MONTHLY_CTE,
    select=" UNION ALL ".join([_summary_sql("Diario", "d"), _summary_sql("Semanal", "w"),
                               _summary_sql("Mensual", "m")])), "D27")
def period_summary(spark, sf):
    return tm.period_summary(sales(spark, sf), lambda df, name: facts.staged(spark, sf, name, lambda: df))


@register("moving_average", with_sales(_DAILY_CTE, select="""
SELECT *, CASE WHEN count(*) OVER w7 = 7 THEN round(avg(Total_Productos_Vendidos) OVER w7, 6) END AS MA_7,
       CASE WHEN count(*) OVER w14 = 14 THEN round(avg(Total_Productos_Vendidos) OVER w14, 6) END AS MA_14,
       CASE WHEN count(*) OVER w30 = 30 THEN round(avg(Total_Productos_Vendidos) OVER w30, 6) END AS MA_30
FROM d WINDOW w7 AS (ORDER BY Fecha ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
              w14 AS (ORDER BY Fecha ROWS BETWEEN 13 PRECEDING AND CURRENT ROW),
              w30 AS (ORDER BY Fecha ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"""), "E1")
def moving_average(spark, sf):
    return tm.moving_average(tm.period_sales(sales(spark, sf), "day"))


@register("moving_average_by_store", with_sales(
    f"ds AS (SELECT ID_Tienda, Fecha, {_PERIOD_AGG} FROM sales GROUP BY ID_Tienda, Fecha)", select="""
SELECT *, CASE WHEN count(*) OVER w7 = 7 THEN round(avg(Total_Productos_Vendidos) OVER w7, 6) END AS MA_7,
       CASE WHEN count(*) OVER w14 = 14 THEN round(avg(Total_Productos_Vendidos) OVER w14, 6) END AS MA_14,
       CASE WHEN count(*) OVER w30 = 30 THEN round(avg(Total_Productos_Vendidos) OVER w30, 6) END AS MA_30
FROM ds WINDOW w7 AS (PARTITION BY ID_Tienda ORDER BY Fecha ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
               w14 AS (PARTITION BY ID_Tienda ORDER BY Fecha ROWS BETWEEN 13 PRECEDING AND CURRENT ROW),
               w30 AS (PARTITION BY ID_Tienda ORDER BY Fecha ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"""), "E1")
def moving_average_by_store(spark, sf):
    """E1 for every store in one job: windows partitioned by store."""
    series = tm.period_sales(sales(spark, sf), "day", keys=["ID_Tienda"])
    return tm.moving_average(series, keys=["ID_Tienda"])


_GROWTH = """round((Total_Productos_Vendidos - lag(Total_Productos_Vendidos) OVER o) * 100.0
             / nullif(lag(Total_Productos_Vendidos) OVER o, 0), 6) AS Crecimiento_Mensual,
       round((Numero_Transacciones - lag(Numero_Transacciones) OVER o) * 100.0
             / nullif(lag(Numero_Transacciones) OVER o, 0), 6) AS Crecimiento_Transacciones"""


@register("monthly_growth", with_sales(_MONTHLY_CTE, select=f"""
SELECT *, {_GROWTH} FROM m WINDOW o AS (ORDER BY Periodo)"""), "E2")
def monthly_growth(spark, sf):
    return tm.growth(tm.period_sales(sales(spark, sf), "month"),
                     names=("Crecimiento_Mensual", "Crecimiento_Transacciones"))


@register("yearly_growth", with_sales(
    f"y AS (SELECT CAST(year(Fecha) AS INTEGER) AS Anio, {_PERIOD_AGG} FROM sales GROUP BY 1)",
    select=f"SELECT *, {_GROWTH.replace('Mensual', 'Anual')} FROM y WINDOW o AS (ORDER BY Anio)"), "E13")
def yearly_growth(spark, sf):
    return tm.growth(tm.period_sales(sales(spark, sf), "year"), order="Anio",
                     names=("Crecimiento_Anual", "Crecimiento_Transacciones"))


@register("trend_verdict", with_sales(_WEEKLY_CTE, select="""
SELECT arg_min(Total_Productos_Vendidos, Periodo) AS Primero, arg_max(Total_Productos_Vendidos, Periodo) AS Ultimo,
       round((arg_max(Total_Productos_Vendidos, Periodo) - arg_min(Total_Productos_Vendidos, Periodo)) * 100.0
             / arg_min(Total_Productos_Vendidos, Periodo), 6) AS Cambio_Pct,
       CASE WHEN arg_max(Total_Productos_Vendidos, Periodo) > arg_min(Total_Productos_Vendidos, Periodo) THEN 'CRECIENTE'
            WHEN arg_max(Total_Productos_Vendidos, Periodo) < arg_min(Total_Productos_Vendidos, Periodo) THEN 'DECRECIENTE'
            ELSE 'ESTABLE' END AS Tendencia FROM w"""), "E3")
def trend_verdict(spark, sf):
    return tm.trend_verdict(tm.period_sales(sales(spark, sf), "week"))


@register("trend_verdict_by_store", with_sales(
    f"ws AS (SELECT ID_Tienda, {_WEEK_SQL} AS Periodo, count(*) AS Total_Productos_Vendidos FROM sales GROUP BY 1, 2)",
    select="""
SELECT ID_Tienda, arg_min(Total_Productos_Vendidos, Periodo) AS Primero, arg_max(Total_Productos_Vendidos, Periodo) AS Ultimo,
       round((arg_max(Total_Productos_Vendidos, Periodo) - arg_min(Total_Productos_Vendidos, Periodo)) * 100.0
             / arg_min(Total_Productos_Vendidos, Periodo), 6) AS Cambio_Pct,
       CASE WHEN arg_max(Total_Productos_Vendidos, Periodo) > arg_min(Total_Productos_Vendidos, Periodo) THEN 'CRECIENTE'
            WHEN arg_max(Total_Productos_Vendidos, Periodo) < arg_min(Total_Productos_Vendidos, Periodo) THEN 'DECRECIENTE'
            ELSE 'ESTABLE' END AS Tendencia FROM ws GROUP BY ID_Tienda"""), "E3")
def trend_verdict_by_store(spark, sf):
    """E3 for every store in one aggregation."""
    return tm.trend_verdict(tm.period_sales(sales(spark, sf), "week", keys=["ID_Tienda"]), keys=["ID_Tienda"])


_DECOMP_CTES = (
    "dd AS (SELECT Fecha, count(*) AS Total_Productos_Vendidos FROM sales GROUP BY Fecha)",
    """p AS (SELECT *, row_number() OVER (ORDER BY Fecha) - 1 AS pos FROM dd)""",
    """t AS (SELECT *, CASE WHEN count(*) OVER (ORDER BY pos ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) = 7
          THEN avg(Total_Productos_Vendidos) OVER (ORDER BY pos ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) END AS tr,
          pos % 7 AS ph FROM p)""",
    "s0 AS (SELECT ph, avg(Total_Productos_Vendidos - tr) AS s FROM t GROUP BY ph)",
    "s1 AS (SELECT ph, s - avg(s) OVER () AS s FROM s0)",
    """dec AS (SELECT Fecha, Total_Productos_Vendidos, round(tr, 6) AS Tendencia, round(s, 6) AS Estacionalidad,
          round(Total_Productos_Vendidos - tr - s, 6) AS Residuo, Total_Productos_Vendidos - tr - s AS raw_r
          FROM t JOIN s1 USING (ph))""",
)


@register("seasonal_decompose", with_sales(*_DECOMP_CTES, select="""
SELECT Fecha, Total_Productos_Vendidos, Tendencia, Estacionalidad, Residuo FROM dec"""), "E4")
def seasonal_decompose(spark, sf):
    daily = sales(spark, sf).groupBy("Fecha").agg(F.count(F.lit(1)).alias("Total_Productos_Vendidos"))
    return tm.seasonal_decompose(daily, period=7)


@register("seasonal_decompose_by_store", with_sales(
    "dd AS (SELECT ID_Tienda, Fecha, count(*) AS v FROM sales GROUP BY ID_Tienda, Fecha)",
    "p AS (SELECT *, row_number() OVER (PARTITION BY ID_Tienda ORDER BY Fecha) - 1 AS pos FROM dd)",
    """t AS (SELECT *, CASE WHEN count(*) OVER w = 7 THEN avg(v) OVER w END AS tr, pos % 7 AS ph FROM p
          WINDOW w AS (PARTITION BY ID_Tienda ORDER BY pos ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING))""",
    "s0 AS (SELECT ID_Tienda, ph, avg(v - tr) AS s FROM t GROUP BY 1, 2)",
    "s1 AS (SELECT ID_Tienda, ph, s - avg(s) OVER (PARTITION BY ID_Tienda) AS s FROM s0)",
    select="""SELECT ID_Tienda, Fecha, v AS Total_Productos_Vendidos, round(tr, 6) AS Tendencia,
       round(s, 6) AS Estacionalidad, round(v - tr - s, 6) AS Residuo FROM t JOIN s1 USING (ID_Tienda, ph)"""), "E4")
def seasonal_decompose_by_store(spark, sf):
    """E4 for every store in one job: windows and phase means partitioned by store."""
    daily = sales(spark, sf).groupBy("ID_Tienda", "Fecha").agg(F.count(F.lit(1)).alias("Total_Productos_Vendidos"))
    return tm.seasonal_decompose(daily, period=7, keys=["ID_Tienda"])


@register("unusual_days", with_sales(*_DECOMP_CTES, select=f"""
SELECT Fecha, Residuo, round(sd, 6) AS Desv_Residuo, CASE WHEN Residuo < 0 THEN 'CAIDA' ELSE 'PICO' END AS Tipo
FROM (SELECT *, stddev_samp(Residuo) OVER () AS sd FROM dec) x WHERE abs(Residuo) > {UNUSUAL_K} * sd"""), "E14")
def unusual_days(spark, sf):
    daily = sales(spark, sf).groupBy("Fecha").agg(F.count(F.lit(1)).alias("Total_Productos_Vendidos"))
    return tm.unusual_days(tm.seasonal_decompose(daily, period=7), UNUSUAL_K)


@register("daily_filled", with_sales(
    "dd AS (SELECT Fecha, count(*) AS Total_Productos_Vendidos FROM sales GROUP BY Fecha)",
    """g AS (SELECT CAST(x AS DATE) AS Fecha FROM
          generate_series((SELECT min(Fecha) FROM dd), (SELECT max(Fecha) FROM dd), INTERVAL 1 DAY) t(x))""",
    select="""SELECT g.Fecha, last_value(dd.Total_Productos_Vendidos IGNORE NULLS) OVER (ORDER BY g.Fecha
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS Total_Productos_Vendidos,
       dd.Total_Productos_Vendidos IS NULL AS Relleno FROM g LEFT JOIN dd USING (Fecha)"""), "E11")
def daily_filled(spark, sf):
    daily = sales(spark, sf).groupBy("Fecha").agg(F.count(F.lit(1)).alias("Total_Productos_Vendidos"))
    full = tm.complete_days(daily).withColumn("Relleno", F.col("Total_Productos_Vendidos").isNull())
    return tm.fill_forward(full, ["Total_Productos_Vendidos"]).select("Fecha", "Total_Productos_Vendidos", "Relleno")
