"""Registered profiling, statistics, check and scalar-function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketry.functions import calendar as cal
from basketry.functions.labels import cut, histogram, ratio, rnd
from basketry.operators import customers as cu
from basketry.operators import profile as pf
from basketry.plans.facts import sales
from basketry.plans.registry import register, with_sales
from basketry.sources import tables as tb

# Fixed parameters of the registered queries.
HEAD_K = 5
HIST_BINS = 50
BOX_LIMIT = 30
LABEL_PRODUCT = 7

_SPARK_TYPES = {"ID_Categoria": "int", "ID_Producto": "bigint", "Fecha": "date", "ID_Tienda": "int",
                "ID_Transaccion": "bigint", "Nombre_Categoria": "string", "Anio": "int", "Mes": "int", "Dia": "int",
                "Dia_Semana": "int", "Semana_Anio": "int", "Hora": "int", "HoraDelDia": "int", "DiaSemana": "int",
                "DiaSemana_L0": "int"}


def _profile_sql() -> str:
    parts = [f"""SELECT 'sales' AS Tabla, {i} AS Posicion, '{c}' AS Columna, '{_SPARK_TYPES[c]}' AS Tipo,
        count(*) AS Filas, count({c}) AS No_Nulos, count(*) - count({c}) AS Nulos, {len(tb.SALES_COLUMNS)} AS Num_Columnas
        FROM sales""" for i, c in enumerate(tb.SALES_COLUMNS)]
    return with_sales(select="\nUNION ALL ".join(parts))


@register("profile_table", _profile_sql(), "I1 I3 I4")
def profile_table(spark, sf):
    return pf.profile_table(sales(spark, sf), "sales")


@register("profile_head", with_sales(select=f"""
SELECT {', '.join(tb.SALES_COLUMNS)} FROM sales
ORDER BY ID_Transaccion, ID_Producto LIMIT {HEAD_K}"""), "I2")
def profile_head(spark, sf):
    return pf.profile_head(sales(spark, sf), HEAD_K, ["ID_Transaccion", "ID_Producto"])


@register("profile_duplicates", with_sales(select=f"""
SELECT CAST(sum(n) AS BIGINT) AS Filas, count(*) AS Filas_Distintas, CAST(sum(n - 1) AS BIGINT) AS Duplicados
FROM (SELECT {', '.join(tb.SALES_COLUMNS)}, count(*) AS n FROM sales GROUP BY ALL) x"""), "I5")
def profile_duplicates(spark, sf):
    return pf.duplicate_rows(sales(spark, sf))


_RF_CTE = """rf AS (SELECT ID_Tienda, ID_Transaccion,
      CAST(date_diff('day', max(Fecha), (SELECT max(Fecha) + 1 FROM sales)) AS INTEGER) AS Recencia_Dias,
      count(*) AS Productos_Comprados FROM sales GROUP BY ID_Tienda, ID_Transaccion)"""


def _describe_sql(src: str, col: str, keys: str = "") -> str:
    k = f"{keys}, " if keys else ""
    g = f" GROUP BY {keys}" if keys else ""
    return f"""SELECT {k}'{col}' AS Columna, count({col}) AS Cuenta, round(avg({col}), 6) AS Media,
       round(stddev_samp({col}), 6) AS Desv_Std, CAST(min({col}) AS DOUBLE) AS Minimo,
       round(quantile_cont({col}, 0.25), 6) AS P25, round(quantile_cont({col}, 0.5), 6) AS P50,
       round(quantile_cont({col}, 0.75), 6) AS P75, CAST(max({col}) AS DOUBLE) AS Maximo FROM {src}{g}"""


@register("describe_numeric", with_sales(_RF_CTE, select=_describe_sql("rf", "Recencia_Dias") + " UNION ALL "
                                         + _describe_sql("rf", "Productos_Comprados")), "I6")
def describe_numeric(spark, sf):
    rf = cu.rf_features(sales(spark, sf))
    return pf.describe(rf, ["Recencia_Dias", "Productos_Comprados"])


@register("describe_by_store", with_sales(select=_describe_sql("baskets", "Productos_Comprados", "Tienda")),
          "I11")
def describe_by_store(spark, sf):
    return pf.describe(cu.basket_table(sales(spark, sf)), ["Productos_Comprados"], keys=["Tienda"])


@register("basket_stats", with_sales(
    "mo AS (SELECT Productos_Comprados AS v, count(*) AS n FROM baskets GROUP BY 1)",
    select="""SELECT count(*) AS Num_Transacciones, round(avg(Productos_Comprados), 6) AS Media,
       round(quantile_cont(Productos_Comprados, 0.5), 6) AS Mediana,
       (SELECT min(v) FROM mo WHERE n = (SELECT max(n) FROM mo)) AS Moda,
       round(stddev_samp(Productos_Comprados), 6) AS Desv_Std FROM baskets"""), "I7 I8")
def basket_stats(spark, sf):
    return pf.basket_stats(cu.basket_table(sales(spark, sf)))


@register("basket_modes", with_sales(
    "mo AS (SELECT Productos_Comprados, count(*) AS Frecuencia FROM baskets GROUP BY 1)",
    select="SELECT * FROM mo WHERE Frecuencia = (SELECT max(Frecuencia) FROM mo)"), "I7")
def basket_modes(spark, sf):
    return pf.modes(cu.basket_table(sales(spark, sf)), "Productos_Comprados")


@register("basket_boxplot", with_sales(
    """q AS (SELECT quantile_cont(Productos_Comprados, 0.25) AS Q1, quantile_cont(Productos_Comprados, 0.75) AS Q3
          FROM baskets),
    f AS (SELECT Q1, Q3, Q3 - Q1 AS IQR, Q1 - 1.5 * (Q3 - Q1) AS Limite_Inf, Q3 + 1.5 * (Q3 - Q1) AS Limite_Sup FROM q)""",
    select=f"""SELECT max(Q1) AS Q1, max(Q3) AS Q3, max(IQR) AS IQR, max(Limite_Inf) AS Limite_Inf,
       max(Limite_Sup) AS Limite_Sup,
       CAST(min(CASE WHEN Productos_Comprados BETWEEN Limite_Inf AND Limite_Sup THEN Productos_Comprados END) AS DOUBLE)
         AS Bigote_Inf,
       CAST(max(CASE WHEN Productos_Comprados BETWEEN Limite_Inf AND Limite_Sup THEN Productos_Comprados END) AS DOUBLE)
         AS Bigote_Sup,
       count(CASE WHEN NOT (Productos_Comprados BETWEEN Limite_Inf AND Limite_Sup) THEN 1 END) AS Atipicos,
       count(*) AS Total,
       round(avg(CASE WHEN Productos_Comprados > {BOX_LIMIT} THEN 1 ELSE 0 END) * 100, 6) AS Pct_Sobre_Limite,
       round(count(CASE WHEN NOT (Productos_Comprados BETWEEN Limite_Inf AND Limite_Sup) THEN 1 END) * 100.0
             / count(*), 6) AS Pct_Atipicos
FROM baskets, f"""), "I9 I10")
def basket_boxplot(spark, sf):
    return pf.boxplot(cu.basket_table(sales(spark, sf)), "Productos_Comprados", limit=BOX_LIMIT)


@register("histogram_units", with_sales(
    """mm AS (SELECT CAST(min(Productos_Comprados) AS DOUBLE) AS lo, CAST(max(Productos_Comprados) AS DOUBLE) AS hi
           FROM baskets)""",
    select=f"""SELECT Bin, round(lo + Bin * (CASE WHEN hi = lo THEN 0.0 ELSE (hi - lo) / {HIST_BINS} END), 6) AS Desde,
       round(lo + (Bin + 1) * (CASE WHEN hi = lo THEN 0.0 ELSE (hi - lo) / {HIST_BINS} END), 6) AS Hasta,
       count(*) AS Frecuencia
FROM (SELECT CAST(least(CASE WHEN hi = lo THEN 0 ELSE floor((Productos_Comprados - lo) / ((hi - lo) / {HIST_BINS})) END,
                        {HIST_BINS - 1}) AS INTEGER) AS Bin, lo, hi FROM baskets, mm) x
GROUP BY Bin, lo, hi"""), "H14")
def histogram_units(spark, sf):
    return histogram(cu.basket_table(sales(spark, sf)), "Productos_Comprados", HIST_BINS)


@register("check_integrity", with_sales(
    """lines AS (SELECT l.l_partkey AS ID_Producto, CAST(o.o_orderdate AS DATE) AS Fecha FROM lineitem l
        JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey)""",
    select="""SELECT 'lineas_sin_categoria' AS Chequeo, count(*) AS Valor, count(*) = 0 AS OK
  FROM lines WHERE ID_Producto NOT IN (SELECT ID_Producto FROM pcat)
UNION ALL SELECT 'categorias_sin_nombre', count(*), count(*) = 0 FROM pcat
  WHERE ID_Categoria NOT IN (SELECT ID_Categoria FROM cats)
UNION ALL SELECT 'productos_multicategoria', count(*), count(*) = 0
  FROM (SELECT ID_Producto FROM pcat GROUP BY 1 HAVING count(DISTINCT ID_Categoria) > 1) x
UNION ALL SELECT 'lineas_fecha_nula', count(*) FILTER (WHERE Fecha IS NULL),
  count(*) FILTER (WHERE Fecha IS NULL) = 0 FROM lines"""), "I14")
def check_integrity(spark, sf):
    cats = tb.categories(spark, sf)
    lines = sales(spark, sf).select("ID_Producto", "Fecha")
    return pf.check_integrity(lines, tb.product_category(spark, sf, cats), cats)


@register("calendar_features", with_sales(select="""
SELECT Fecha, CAST(year(Fecha) AS INTEGER) AS Anio, CAST(month(Fecha) AS INTEGER) AS Mes,
       CAST(day(Fecha) AS INTEGER) AS Dia, CAST(dayofweek(Fecha) + 1 AS INTEGER) AS Dia_Semana,
       CAST(weekofyear(Fecha) AS INTEGER) AS Semana_Anio, CAST(isodow(Fecha) - 1 AS INTEGER) AS DiaSemana_L0,
       strftime(Fecha, '%Y-%m') AS Periodo_Mes,
       CAST(year(Fecha) AS VARCHAR) || '-W' || strftime(Fecha, '%U') AS Semana_Etiqueta,
       strftime(Fecha, '%A') AS Nombre_Dia, strftime(Fecha, '%B') AS Nombre_Mes,
       ['Lunes', 'Martes', 'Miércoles', 'Jueves', 'Viernes', 'Sábado', 'Domingo'][isodow(Fecha)] AS Dia_ES,
       ['Enero', 'Febrero', 'Marzo', 'Abril', 'Mayo', 'Junio', 'Julio', 'Agosto', 'Septiembre', 'Octubre',
        'Noviembre', 'Diciembre'][month(Fecha)] AS Mes_ES,
       CAST(epoch(Fecha) AS BIGINT) AS Epoch_Seg,
       CAST(Fecha + INTERVAL 7 DAY AS DATE) AS Fecha_Mas_7,
       CAST(date_diff('day', (SELECT min(Fecha) FROM sales), Fecha) AS INTEGER) AS Dias_Desde_Inicio
FROM (SELECT DISTINCT Fecha FROM sales) d"""), "H1 H2 H3 H4 H6 H15")
def calendar_features(spark, sf):
    s = sales(spark, sf)
    d = s.select("Fecha").distinct()
    first = s.agg(F.min("Fecha")).scalar()
    out = cal.calendar_features(d.withColumns({
        "Anio": F.year("Fecha"), "Mes": F.month("Fecha"), "Dia": F.dayofmonth("Fecha"),
        "Dia_Semana": F.dayofweek("Fecha"), "Semana_Anio": F.weekofyear("Fecha"),
        "DiaSemana_L0": cal.weekday_monday0("Fecha")}))
    return out.withColumns({"Fecha_Mas_7": F.date_add("Fecha", 7),
                            "Dias_Desde_Inicio": F.datediff(F.col("Fecha"), first)})


@register("label_functions", with_sales(
    """b AS (SELECT ID_Tienda, ID_Transaccion, count(*) AS u, list_sort(list(DISTINCT ID_Producto)) AS items
        FROM sales GROUP BY 1, 2)""",
    select=f"""SELECT ID_Tienda, ID_Transaccion,
       array_to_string(items, ', ') AS Items_Txt, CAST(len(items) AS INTEGER) AS Num_Items,
       list_contains(items, {LABEL_PRODUCT}) AS Contiene_Producto,
       TRY_CAST(string_split(array_to_string(items, ', '), ', ')[1] AS BIGINT) AS Primer_Producto,
       CAST(ID_Transaccion % 24 AS INTEGER) AS Hora,
       round(CAST(u AS DOUBLE) / nullif(len(items), 0), 2) AS Unidades_Por_Item,
       CASE WHEN u <= 5 THEN 'Compra Pequeña (1-5 productos)' WHEN u <= 15 THEN 'Compra Media (6-15 productos)'
            WHEN u <= 30 THEN 'Compra Grande (16-30 productos)' ELSE 'Compra Muy Grande (>30 productos)' END
         AS Segmento_Tamano,
       CASE WHEN u > 0 AND u <= 5 THEN 'Baja (1-5)' WHEN u > 5 AND u <= 15 THEN 'Media (6-15)'
            WHEN u > 15 AND u <= 30 THEN 'Alta (16-30)' WHEN u > 30 THEN 'Muy Alta (>30)' END AS Banda,
       coalesce(CASE WHEN u > 0 AND u <= 5 THEN 'Baja (1-5)' WHEN u > 5 AND u <= 15 THEN 'Media (6-15)'
            WHEN u > 15 AND u <= 30 THEN 'Alta (16-30)' WHEN u > 30 THEN 'Muy Alta (>30)' END, 'nan')
         || ' / ' || CAST(len(items) AS VARCHAR) AS Etiqueta
FROM b"""), "H7 H8 H9 H10 H11 H12 H13")
def label_functions(spark, sf):
    s = sales(spark, sf)
    b = s.groupBy("ID_Tienda", "ID_Transaccion").agg(
        F.count(F.lit(1)).alias("u"), F.array_sort(F.collect_set("ID_Producto")).alias("items"))
    txt = F.concat_ws(", ", F.transform("items", lambda x: x.cast("string")))
    band = cut(F.col("u"), cu.UNITS_BINS, cu.UNITS_LABELS)
    c = F.col("u")
    seg = F.when(c <= 5, cu.SIZE_LABELS[0]).when(c <= 15, cu.SIZE_LABELS[1]) \
        .when(c <= 30, cu.SIZE_LABELS[2]).otherwise(cu.SIZE_LABELS[3])
    return b.select(
        "ID_Tienda", "ID_Transaccion",
        txt.alias("Items_Txt"),
        F.size("items").alias("Num_Items"),
        F.array_contains("items", LABEL_PRODUCT).alias("Contiene_Producto"),
        F.split(txt, ", ").getItem(0).try_cast("bigint").alias("Primer_Producto"),
        cal.simulated_hour("ID_Transaccion").alias("Hora"),
        rnd(ratio(c.cast("double"), F.size("items")), 2).alias("Unidades_Por_Item"),
        seg.alias("Segmento_Tamano"),
        band.alias("Banda"),
        F.concat_ws(" / ", F.coalesce(band, F.lit("nan")), F.size("items").cast("string")).alias("Etiqueta"),
    )
