"""Dashboard and report queries: KPIs, slices, rankings, shares, stores."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketry.operators import customers as cu
from basketry.operators import kpi
from basketry.operators import products as pr
from basketry.operators import segment as sg
from basketry.operators import sketches as sk
from basketry.plans import facts
from basketry.plans.facts import sales
from basketry.plans.registry import register, with_sales
from basketry.plans.segment_queries import _ASSIGN_CTE, _Z_CTES, FIXED_CENTERS

# Fixed parameters of the registered report queries.
SLICE_STORES = tuple(range(0, 13))
SLICE_START, SLICE_END = "1996-01-01", "1998-12-31"
SLICE_CATEGORIES = ("ECONOMY", "PROMO", "DESCONOCIDA")
LOOKUP_PRODUCT = 7
OTHERS_TOP_N = 15
SLICE_CLUSTERS = (0, 2)

_KPI_SELECT = """
SELECT count(DISTINCT (ID_Tienda, ID_Transaccion)) AS Total_Transacciones, count(*) AS Total_Productos_Vendidos,
       count(DISTINCT ID_Producto) AS Productos_Unicos, count(DISTINCT Nombre_Categoria) AS Categorias_Activas,
       coalesce(round(CAST(count(*) AS DOUBLE) / nullif(count(DISTINCT (ID_Tienda, ID_Transaccion)), 0), 6), 0.0)
         AS Promedio_Productos_Transaccion
FROM {src}"""


def _top_products_sql(n: int, measure: str, share: bool) -> str:
    value = "Unidades_Vendidas" if measure == "units" else "Num_Transacciones"
    agg = "count(*)" if measure == "units" else "count(DISTINCT (ID_Tienda, ID_Transaccion))"
    total = "(SELECT count(*) FROM sales)" if measure == "units" else \
        "(SELECT count(DISTINCT (ID_Tienda, ID_Transaccion)) FROM sales)"
    share_col = f", round(CAST({value} AS DOUBLE) * 100 / {total}, 6) AS Porcentaje" if share else ""
    return with_sales(
        f"""top AS (SELECT ID_Producto, min(Nombre_Categoria) AS Nombre_Categoria, {agg} AS {value}
        FROM sales GROUP BY ID_Producto ORDER BY {value} DESC, ID_Producto LIMIT {n})""",
        select=f"""SELECT CAST(row_number() OVER (ORDER BY {value} DESC, ID_Producto) AS INTEGER) AS Posicion,
        ID_Producto, Nombre_Categoria, {value}{share_col} FROM top""")


@register("top_products_volume", _top_products_sql(10, "units", False), "D3 C5 F1")
def top_products_volume(spark, sf):
    return pr.top_products(sales(spark, sf), 10, "units")


@register("top_products_reach", _top_products_sql(10, "reach", False), "D4 C5 F2")
def top_products_reach(spark, sf):
    return pr.top_products(sales(spark, sf), 10, "reach")


@register("top_products_share", _top_products_sql(5, "units", True), "D6 E12")
def top_products_share(spark, sf):
    return pr.top_products(sales(spark, sf), 5, "units", share=True)


@register("top_categories", with_sales(
    """top AS (SELECT Nombre_Categoria, count(*) AS Unidades_Vendidas, count(DISTINCT ID_Producto) AS Num_Productos
       FROM sales GROUP BY Nombre_Categoria ORDER BY Unidades_Vendidas DESC, Nombre_Categoria LIMIT 10)""",
    select="""SELECT CAST(row_number() OVER (ORDER BY Unidades_Vendidas DESC, Nombre_Categoria) AS INTEGER) AS Posicion,
       Nombre_Categoria, Unidades_Vendidas, Num_Productos,
       round(CAST(Unidades_Vendidas AS DOUBLE) * 100 / (SELECT count(*) FROM sales), 6) AS Porcentaje FROM top"""),
    "D5 D6 C4")
def top_categories(spark, sf):
    return pr.top_categories(sales(spark, sf), 10)


@register("bottom_products", with_sales(
    """b AS (SELECT ID_Producto, min(Nombre_Categoria) AS Nombre_Categoria, count(*) AS Unidades_Vendidas
       FROM sales GROUP BY ID_Producto ORDER BY Unidades_Vendidas, ID_Producto LIMIT 10)""",
    select="""SELECT CAST(row_number() OVER (ORDER BY Unidades_Vendidas, ID_Producto) AS INTEGER) AS Posicion,
       ID_Producto, Nombre_Categoria, Unidades_Vendidas FROM b"""), "F6")
def bottom_products(spark, sf):
    return pr.bottom_products(sales(spark, sf), 10)


@register("top_plus_others", with_sales(
    f"""c AS (SELECT ID_Producto, count(*) AS Unidades_Vendidas, row_number() OVER (ORDER BY count(*) DESC, ID_Producto) AS r
            FROM sales GROUP BY ID_Producto)""",
    select=f"""SELECT CAST(least(r, {OTHERS_TOP_N + 1}) AS INTEGER) AS Posicion,
       CASE WHEN r <= {OTHERS_TOP_N} THEN CAST(ID_Producto AS VARCHAR) ELSE 'Otros' END AS Producto,
       CAST(sum(Unidades_Vendidas) AS BIGINT) AS Unidades_Vendidas FROM c GROUP BY 1, 2"""), "F7")
def top_plus_others(spark, sf):
    return pr.top_plus_others(sales(spark, sf), OTHERS_TOP_N)


@register("top_products_by_store", with_sales(
    """c AS (SELECT ID_Tienda, ID_Producto, count(*) AS Unidades_Vendidas FROM sales GROUP BY 1, 2),
    r AS (SELECT ID_Tienda, CAST(row_number() OVER (PARTITION BY ID_Tienda ORDER BY Unidades_Vendidas DESC,
          ID_Producto) AS INTEGER) AS Posicion, ID_Producto, Unidades_Vendidas FROM c)""",
    select="SELECT * FROM r WHERE Posicion <= 10"), "E10")
def top_products_by_store(spark, sf):
    return pr.top_per_store(sales(spark, sf), 10)


@register("pareto_products", with_sales(
    """p AS (SELECT ID_Producto, count(*) AS u FROM sales GROUP BY 1),
    c AS (SELECT u, sum(u) OVER (ORDER BY u DESC, ID_Producto ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
          AS cum, sum(u) OVER () AS n FROM p)""",
    select="""SELECT CAST(sum(CASE WHEN CAST(cum AS DOUBLE) / n * 100 <= 80 THEN 1 ELSE 0 END) AS BIGINT)
         AS Productos_Pareto, count(*) AS Productos_Total, CAST(max(n) AS BIGINT) AS Unidades_Total,
       round(sum(CASE WHEN CAST(cum AS DOUBLE) / n * 100 <= 80 THEN 1 ELSE 0 END) * 100.0 / count(*), 6)
         AS Porcentaje_Catalogo FROM c"""), "E9")
def pareto_products(spark, sf):
    return pr.pareto(sales(spark, sf), 0.8)


@register("pareto_curve", with_sales(
    """p AS (SELECT ID_Producto, count(*) AS u FROM sales GROUP BY 1),
    l AS (SELECT u, count(*) AS Num_Productos FROM p GROUP BY u)""",
    select="""SELECT u AS Unidades_Por_Producto, Num_Productos,
       CAST(sum(Num_Productos) OVER (ORDER BY u DESC) AS BIGINT) AS Productos_Acumulados,
       round(CAST(sum(u * Num_Productos) OVER (ORDER BY u DESC) AS DOUBLE) * 100
             / sum(u * Num_Productos) OVER (), 6) AS Porcentaje_Acumulado FROM l"""), "E9")
def pareto_curve(spark, sf):
    return pr.pareto_curve(sales(spark, sf))


@register("pareto_ranks", with_sales(
    "p AS (SELECT ID_Producto, count(*) AS u FROM sales GROUP BY 1)",
    select="""SELECT ID_Producto, u AS Unidades_Vendidas,
       row_number() OVER (ORDER BY u DESC, ID_Producto) AS Posicion,
       round(CAST(sum(u) OVER (ORDER BY u DESC, ID_Producto ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
             AS DOUBLE) * 100.0 / sum(u) OVER (), 6) AS Porcentaje_Acumulado FROM p"""), "E9")
def pareto_ranks(spark, sf):
    return pr.pareto_ranks(sales(spark, sf))


@register("kpi_summary", with_sales(select=_KPI_SELECT.format(src="sales")), "D1")
def kpi_summary(spark, sf):
    return kpi.kpi_summary(sales(spark, sf))


@register("kpi_filtered", with_sales(
    f"""s AS (SELECT * FROM sales WHERE ID_Tienda IN ({', '.join(map(str, SLICE_STORES))})
          AND Fecha BETWEEN DATE '{SLICE_START}' AND DATE '{SLICE_END}')""",
    select=_KPI_SELECT.format(src="s")), "B9")
def kpi_filtered(spark, sf):
    return kpi.kpi_summary(kpi.slice_sales(sales(spark, sf), SLICE_STORES, SLICE_START, SLICE_END))


_SKETCH_COUNTS = """count(*) AS Unidades, count(DISTINCT ID_Producto) AS Productos, count(DISTINCT Nombre_Categoria) AS Categorias,
       count(DISTINCT (ID_Tienda, ID_Transaccion)) AS Transacciones,
       true AS Productos_En_Cota, true AS Categorias_En_Cota, true AS Transacciones_En_Cota"""


@register("kpi_sketch_bounds", with_sales(select=f"""
SELECT 'total' AS Corte, {_SKETCH_COUNTS} FROM sales
UNION ALL SELECT 'tienda ' || ID_Tienda, {_SKETCH_COUNTS} FROM sales GROUP BY ID_Tienda
UNION ALL SELECT 'mes ' || strftime(Fecha, '%Y-%m'), {_SKETCH_COUNTS} FROM sales GROUP BY strftime(Fecha, '%Y-%m')
UNION ALL SELECT 'corte', {_SKETCH_COUNTS} FROM sales WHERE ID_Tienda IN ({', '.join(map(str, SLICE_STORES))})
  AND Fecha BETWEEN DATE '{SLICE_START}' AND DATE '{SLICE_END}'"""), "D1 D2 D4 B9")
def kpi_sketch_bounds(spark, sf):
    """Exact distinct counts of many slices, and whether the sketches of the same slices keep their bound."""
    s, daily = sales(spark, sf), facts.sketch_facts(spark, sf)
    month, store = F.date_format("Fecha", "yyyy-MM"), F.col("ID_Tienda").cast("string")
    cuts = F.array(F.lit("total"), F.concat(F.lit("tienda "), store), F.concat(F.lit("mes "), month),
                   F.when(F.col("ID_Tienda").isin(list(SLICE_STORES)) &
                          F.col("Fecha").between(F.lit(SLICE_START).cast("date"), F.lit(SLICE_END).cast("date")), "corte"))
    corte = F.explode(F.filter(cuts, lambda c: c.isNotNull())).alias("Corte")
    rolled = sk.merged(daily.select(corte, "Unidades", *sk.SKETCHES), "Corte")
    est = sk.estimates(rolled, "Corte").select("Corte", "Unidades", *[F.col(c).alias(f"e_{c}") for c in sk.SKETCHES])

    def exact(name, *cols):  # distinct pairs first, so that a slice is no single task
        return s.select(corte, *cols).dropna("any").distinct().groupBy("Corte").agg(F.count(F.lit(1)).alias(name))

    out = est.join(exact("Productos", "ID_Producto"), "Corte", "left") \
        .join(exact("Categorias", "Nombre_Categoria"), "Corte", "left") \
        .join(exact("Transacciones", "ID_Tienda", "ID_Transaccion"), "Corte", "left")
    counts = {c: F.coalesce(F.col(c), F.lit(0)) for c in sk.SKETCHES}
    return out.select("Corte", "Unidades", *[v.alias(c) for c, v in counts.items()],
                      *[sk.within(F.col(f"e_{c}"), v).alias(f"{c}_En_Cota") for c, v in counts.items()])


@register("kpi_filtered_cat", with_sales(
    f"""s AS (SELECT * FROM sales WHERE ID_Tienda IN ({', '.join(map(str, SLICE_STORES))})
          AND Nombre_Categoria IN ({', '.join(repr(c) for c in SLICE_CATEGORIES)}))""",
    select=_KPI_SELECT.format(src="s")), "B10")
def kpi_filtered_cat(spark, sf):
    return kpi.kpi_summary(kpi.slice_sales(sales(spark, sf), SLICE_STORES, categories=SLICE_CATEGORIES))


@register("dataset_dimensions", with_sales(select="""
SELECT count(*) AS Registros, count(DISTINCT (ID_Tienda, ID_Transaccion)) AS Transacciones, count(DISTINCT ID_Producto) AS Productos,
       count(DISTINCT Nombre_Categoria) AS Categorias, count(DISTINCT ID_Tienda) AS Tiendas,
       min(Fecha) AS Fecha_Min, max(Fecha) AS Fecha_Max, CAST(max(Fecha) - min(Fecha) AS INTEGER) AS Dias_Rango
FROM sales"""), "D2 I1")
def dataset_dimensions(spark, sf):
    return kpi.dataset_dimensions(sales(spark, sf))


@register("product_lookup", with_sales(select=f"""
SELECT ID_Producto, min(Nombre_Categoria) AS Nombre_Categoria, count(*) AS Unidades_Vendidas
FROM sales WHERE ID_Producto = {LOOKUP_PRODUCT} GROUP BY ID_Producto"""), "D20 B11")
def product_lookup(spark, sf):
    return kpi.product_lookup(sales(spark, sf), LOOKUP_PRODUCT)


@register("store_summary", with_sales(
    """s AS (SELECT Tienda, count(*) AS Total_Transacciones, round(avg(Productos_Comprados), 2)
          AS Promedio_Productos_Transaccion, CAST(sum(Productos_Comprados) AS BIGINT) AS Total_Productos_Vendidos
          FROM baskets GROUP BY Tienda)""",
    select="""SELECT Tienda, Total_Transacciones, Promedio_Productos_Transaccion, Total_Productos_Vendidos,
       round(CAST(Total_Transacciones AS DOUBLE) * 100 / sum(Total_Transacciones) OVER (), 2) AS Participacion_Pct,
       CAST(rank() OVER (ORDER BY Total_Transacciones DESC) AS INTEGER) AS Ranking FROM s"""), "D17 D18")
def store_summary(spark, sf):
    return cu.store_summary(sales(spark, sf))


@register("store_units", with_sales(select="""
SELECT ID_Tienda, count(*) AS Unidades_Vendidas FROM sales GROUP BY ID_Tienda"""), "D17")
def store_units(spark, sf):
    return cu.store_units(sales(spark, sf))


@register("largest_baskets", with_sales(select="""
SELECT ID_Transaccion, Productos_Comprados AS Num_Productos, Fecha_Compra AS Fecha, Tienda
FROM baskets ORDER BY Num_Productos DESC, ID_Transaccion, Tienda LIMIT 10"""), "D7 F2")
def largest_baskets(spark, sf):
    return cu.largest_baskets(sales(spark, sf), 10)


def _metric(name: str, expr: str, src: str) -> str:
    return f"SELECT '{name}' AS Metrica, round(CAST(({expr}) AS DOUBLE), 6) AS Valor FROM {src}"


_EXEC_SQL = with_sales(
    "d AS (SELECT Fecha, count(*) AS v FROM sales GROUP BY Fecha)",
    """g AS (SELECT Fecha_Compra - lag(Fecha_Compra) OVER (ORDER BY Fecha_Compra, ID_Tienda, ID_Transaccion) AS gap
         FROM baskets)""",
    """gc AS (SELECT CASE WHEN gap = 0 THEN 0 WHEN gap = 1 THEN 1 WHEN gap <= 7 THEN 2 WHEN gap <= 14 THEN 3 WHEN gap <= 30
         THEN 4 ELSE 5 END AS k, count(*) AS n FROM g WHERE gap IS NOT NULL GROUP BY 1 ORDER BY n DESC, k LIMIT 1)""",
    "p AS (SELECT ID_Producto, count(*) AS u, row_number() OVER (ORDER BY count(*) DESC, ID_Producto) AS r FROM sales GROUP BY 1)",
    """pc AS (SELECT sum(u) OVER (ORDER BY u DESC, ID_Producto ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
          sum(u) OVER () AS n FROM p)""",
    "wd AS (SELECT DiaSemana_L0 AS k, count(*) AS v FROM sales GROUP BY 1 ORDER BY v DESC, k LIMIT 1)",
    "mo AS (SELECT Mes AS k, count(*) AS v FROM sales GROUP BY 1 ORDER BY v DESC, k LIMIT 1)",
    "tm AS (SELECT strftime(Fecha_Compra, '%Y-%m') AS k, count(*) AS n FROM baskets GROUP BY 1)",
    """sg AS (SELECT CASE WHEN Productos_Comprados <= 5 THEN 0 WHEN Productos_Comprados <= 15 THEN 1
          WHEN Productos_Comprados <= 30 THEN 2 ELSE 3 END AS k, count(*) AS n FROM baskets GROUP BY 1)""",
    "st AS (SELECT Tienda AS k, count(*) AS n FROM baskets GROUP BY 1 ORDER BY n DESC, k LIMIT 1)",
    select="\nUNION ALL ".join([
        _metric("Registros", "count(*)", "sales"),
        _metric("Productos_Unicos", "count(*)", "p"),
        _metric("Tiendas", "count(DISTINCT ID_Tienda)", "sales"),
        _metric("Transacciones", "count(*)", "baskets"),
        _metric("Fecha_Primera", "epoch(min(Fecha)) / 86400", "sales"),
        _metric("Fecha_Ultima", "epoch(max(Fecha)) / 86400", "sales"),
        _metric("Promedio_Ventas_Diarias", "avg(v)", "d"),
        _metric("Promedio_Productos_Por_Compra", "avg(Productos_Comprados)", "baskets"),
        _metric("Mediana_Productos_Por_Compra", "quantile_cont(Productos_Comprados, 0.5)", "baskets"),
        _metric("Minimo_Productos_Por_Compra", "min(Productos_Comprados)", "baskets"),
        _metric("Maximo_Productos_Por_Compra", "max(Productos_Comprados)", "baskets"),
        _metric("Promedio_Transacciones_Mes", "avg(n)", "tm"),
        _metric("Promedio_Dias_Entre_Compras", "avg(gap)", "g"),
        _metric("Mediana_Dias_Entre_Compras", "quantile_cont(gap, 0.5)", "g"),
        _metric("P75_Dias_Entre_Compras", "quantile_cont(gap, 0.75)", "g"),
        _metric("Maximo_Dias_Entre_Compras", "max(gap)", "g"),
        _metric("Rango_Dias_Mas_Comun", "k", "gc"),
        *[_metric(f"Producto_Top_{i}", "ID_Producto", f"p WHERE r = {i}") for i in (1, 2, 3)],
        *[_metric(f"Producto_Top_{i}_Pct", "u * 100.0 / (SELECT count(*) FROM sales)", f"p WHERE r = {i}") for i in (1, 2, 3)],
        _metric("Unidades_Producto_Mas_Vendido", "u", "p WHERE r = 1"),
        _metric("Productos_Pareto_80", "sum(CASE WHEN CAST(cum AS DOUBLE) / n * 100 <= 80 THEN 1 ELSE 0 END)", "pc"),
        _metric("Productos_Pareto_80_Pct",
                "sum(CASE WHEN CAST(cum AS DOUBLE) / n * 100 <= 80 THEN 1 ELSE 0 END) * 100.0 / count(*)", "pc"),
        _metric("Dia_Semana_Top", "k", "wd"),
        _metric("Mes_Top", "k", "mo"),
        *[_metric(f"Segmento_Tamano_{i}_Pct", f"coalesce(sum(n) FILTER (k = {i}), 0) * 100.0 / sum(n)", "sg") for i in range(4)],
        "SELECT 'Segmento_Tamano_Mayor' AS Metrica, CAST(k AS DOUBLE) AS Valor FROM (SELECT k FROM sg ORDER BY n DESC, k LIMIT 1) x",
        _metric("Tienda_Principal", "k", "st"),
        _metric("Tienda_Principal_Pct", "n * 100.0 / (SELECT count(*) FROM baskets)", "st"),
    ]))


@register("executive_summary", _EXEC_SQL, "D28")
def executive_summary(spark, sf):
    return kpi.executive_summary(sales(spark, sf), stage=lambda df, name: facts.staged(spark, sf, name, lambda: df))


@register("kpi_filtered_cluster", with_sales(*_Z_CTES, _ASSIGN_CTE, f"""s AS (SELECT sales.* FROM sales JOIN asg
       USING (ID_Tienda, ID_Transaccion) WHERE asg.Cluster IN ({', '.join(map(str, SLICE_CLUSTERS))}))""",
    select=_KPI_SELECT.format(src="s")), "B10")
def kpi_filtered_cluster(spark, sf):
    clustered = sg.assign(facts.rf_facts(spark, sf), FIXED_CENTERS)
    return kpi.kpi_summary(kpi.slice_sales(sales(spark, sf), clusters=SLICE_CLUSTERS, clustered=clustered))


@register("distinct_choices", with_sales(select="""
SELECT DISTINCT Nombre_Categoria, ID_Producto FROM sales"""), "G3 D19")
def distinct_choices(spark, sf):
    """The (category, product) choices of the dashboard's filters."""
    return pr.distinct_values(sales(spark, sf), "Nombre_Categoria", "ID_Producto")
