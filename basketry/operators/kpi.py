"""Slices, headline figures, data-set dimensions, lookups, summaries
(B9-B11, D1, D2, D20, D28).

A transaction is a (store, transaction number) pair: the same number in two
stores is two baskets.  Distinct counts are plain groupings of the (sliced)
fact by the key in question, each over its own columns only, put together as
scalar subqueries, so no fact row is expanded once per distinct count.  A slice is a plain filter on partition and data
columns, so date ranges prune the year/month partitions of the stage.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.labels import rnd


BASKET_KEYS = ("ID_Tienda", "ID_Transaccion")


def slice_sales(sales: DataFrame, stores=None, start=None, end=None, categories=None,
                products=None, clusters=None, clustered: DataFrame | None = None, keys=BASKET_KEYS) -> DataFrame:
    """Store IN list AND start <= date <= end (inclusive), etc.

    ``clusters`` keeps the baskets that ``clustered`` (basket keys, Cluster) puts into
    one of them, by a semi-join on the basket key.

    ``None`` means no restriction (the dashboard's defaults: all stores,
    first to last date).
    """
    cond = F.lit(True)
    if stores is not None:
        cond = cond & F.col("ID_Tienda").isin(list(stores))
    if start is not None:
        d0 = _dt.date.fromisoformat(start) if isinstance(start, str) else start
        cond = cond & (F.col("Fecha") >= F.lit(d0))
        cond = cond & (F.col("Anio") >= d0.year)  # helps partition pruning
    if end is not None:
        d1 = _dt.date.fromisoformat(end) if isinstance(end, str) else end
        cond = cond & (F.col("Fecha") <= F.lit(d1))
        cond = cond & (F.col("Anio") <= d1.year)
    if categories is not None:
        cond = cond & F.col("Nombre_Categoria").isin(list(categories))
    if products is not None:
        cond = cond & F.col("ID_Producto").isin(list(products))
    out = sales.where(cond)
    if clusters is not None:
        if clustered is None:
            raise ValueError("a slice by cluster needs the clustered baskets")
        wanted = clustered.where(F.col("Cluster").isin(list(clusters))).select(*keys)
        out = out.join(wanted, list(keys), "left_semi")
    return out


def _groups(sales: DataFrame, *cols: str):
    """Number of distinct non-null values of ``cols``, as a scalar subquery."""
    g = sales.select(*cols).dropna("any").groupBy(*cols).agg(F.lit(1).alias("_one"))
    return g.agg(F.count(F.lit(1))).scalar()


def kpi_summary(sales: DataFrame, approx: bool = False, keys=BASKET_KEYS) -> DataFrame:
    """Transactions, units, products, categories, units per transaction.

    ``approx`` replaces the distinct products by HyperLogLog++ (fixed memory, ~1 % error).
    """
    b = sales.groupBy(*keys).agg(F.count(F.lit(1)).alias("_u"))
    products = sales.agg(F.approx_count_distinct("ID_Producto")).scalar() if approx else _groups(sales, "ID_Producto")
    one = b.agg(F.count(F.lit(1)).alias("Total_Transacciones"),
                F.coalesce(F.sum("_u"), F.lit(0)).alias("Total_Productos_Vendidos"))
    return one.withColumn("Productos_Unicos", products) \
        .withColumn("Categorias_Activas", _groups(sales, "Nombre_Categoria")) \
        .withColumn("Promedio_Productos_Transaccion",
                    F.coalesce(rnd(F.try_divide(F.col("Total_Productos_Vendidos").cast("double"),
                                                F.col("Total_Transacciones")), 6), F.lit(0.0)))


def dataset_dimensions(sales: DataFrame, approx: bool = False, keys=BASKET_KEYS) -> DataFrame:
    """Rows, transactions, products, categories, stores, date range and span."""
    b = sales.groupBy(*keys).agg(F.count(F.lit(1)).alias("_u"), F.min("Fecha").alias("_a"), F.max("Fecha").alias("_b"))
    products = sales.agg(F.approx_count_distinct("ID_Producto")).scalar() if approx else _groups(sales, "ID_Producto")
    one = b.agg(F.coalesce(F.sum("_u"), F.lit(0)).alias("Registros"), F.count(F.lit(1)).alias("Transacciones"),
                F.min("_a").alias("Fecha_Min"), F.max("_b").alias("Fecha_Max"))
    return one.select("Registros", "Transacciones", products.alias("Productos"),
                      _groups(sales, "Nombre_Categoria").alias("Categorias"), _groups(sales, "ID_Tienda").alias("Tiendas"),
                      "Fecha_Min", "Fecha_Max", F.datediff("Fecha_Max", "Fecha_Min").alias("Dias_Rango"))


def product_lookup(sales: DataFrame, product: int) -> DataFrame:
    """Category and units of one product (no row when it never sold)."""
    return (sales.where(F.col("ID_Producto") == F.lit(product))
            .groupBy("ID_Producto")
            .agg(F.min("Nombre_Categoria").alias("Nombre_Categoria"),
                 F.count(F.lit(1)).alias("Unidades_Vendidas")))


def executive_summary(sales: DataFrame, limit: float = 0.8, stage=None) -> DataFrame:
    """(Metrica, Valor) rows, all derived from three aggregates of the fact.

    The fact is read for baskets (store, transaction, date), products and days; ``stage``
    (frame, name -> frame) writes each once, and every metric comes from those small
    tables.  Dates are days since 1970, segments and gap ranges their order numbers.
    """
    from basketry.operators import customers as cu
    from basketry.operators import products as pr

    stage = stage or (lambda df, name: df)
    basket = stage(cu.basket_table(sales), "baskets")
    product = stage(sales.groupBy("ID_Producto").agg(F.count(F.lit(1)).alias("u")), "product-units")
    day = stage(sales.groupBy("Fecha", "DiaSemana_L0", "Mes").agg(F.count(F.lit(1)).alias("v")), "day-units")

    def metrics(df: DataFrame, **values) -> DataFrame:
        """One aggregate (or row) -> one (Metrica, Valor) row per named value."""
        one = df.select(*[v.alias(k) for k, v in values.items()])
        rows = [F.struct(F.lit(k).alias("Metrica"), rnd(F.col(k).cast("double"), 6).alias("Valor")) for k in values]
        return one.select(F.inline(F.array(*rows)))

    size = F.col("Productos_Comprados")
    seg = F.when(size <= cu.SIZE_BOUNDS[0], 0).when(size <= cu.SIZE_BOUNDS[1], 1).when(size <= cu.SIZE_BOUNDS[2], 2).otherwise(3)
    share = {f"Segmento_Tamano_{i}_Pct": F.avg(F.when(seg == i, 100.0).otherwise(0.0)) for i in range(4)}
    bsk = basket.agg(F.count(F.lit(1)).alias("n"), F.avg(size).alias("m"), F.median(size).alias("md"), F.min(size).alias("lo"),
                     F.max(size).alias("hi"), F.count_distinct("Tienda").alias("t"), *[v.alias(k) for k, v in share.items()])
    months = basket.groupBy(F.date_format("Fecha_Compra", "yyyy-MM").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    stores = basket.groupBy(F.col("Tienda").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    segments = basket.groupBy(seg.alias("k")).agg(F.count(F.lit(1)).alias("n"))
    gaps = cu.purchase_gaps(basket)
    gap = F.col("Dias")
    pct = lambda q: F.percentile(gap, q, F.col("Peso"))
    ranges = cu.gap_ranges(gaps)
    units = product.agg(F.sum("u")).scalar()
    total = basket.agg(F.count(F.lit(1))).scalar()
    best = product.orderBy(F.col("u").desc(), F.col("ID_Producto").asc()).limit(3)
    ranked = best.agg(F.array_sort(F.collect_list(F.struct((-F.col("u")).alias("u"), "ID_Producto"))).alias("b"))

    def top(df, value, key="k"):
        return df.orderBy(F.col(value).desc(), F.col(key).asc()).limit(1)

    parts = [
        metrics(product.agg(F.sum("u").alias("r"), F.count(F.lit(1)).alias("p")), Registros=F.col("r"), Productos_Unicos=F.col("p")),
        metrics(bsk, Tiendas=F.col("t"), Transacciones=F.col("n"), Promedio_Productos_Por_Compra=F.col("m"),
                Mediana_Productos_Por_Compra=F.col("md"), Minimo_Productos_Por_Compra=F.col("lo"),
                Maximo_Productos_Por_Compra=F.col("hi"), **{k: F.col(k) for k in share}),
        metrics(day.agg(F.unix_date(F.min("Fecha")).alias("a"), F.unix_date(F.max("Fecha")).alias("b"), F.avg("v").alias("v")),
                Fecha_Primera=F.col("a"), Fecha_Ultima=F.col("b"), Promedio_Ventas_Diarias=F.col("v")),
        metrics(months.agg(F.avg("n").alias("v")), Promedio_Transacciones_Mes=F.col("v")),
        metrics(gaps.agg(F.try_divide(F.sum(gap * F.col("Peso")), F.sum("Peso")).alias("m"), pct(0.5).alias("p50"),
                         pct(0.75).alias("p75"), F.max(gap).alias("hi")),
                Promedio_Dias_Entre_Compras=F.col("m"), Mediana_Dias_Entre_Compras=F.col("p50"),
                P75_Dias_Entre_Compras=F.col("p75"), Maximo_Dias_Entre_Compras=F.col("hi")),
        metrics(top(ranges, "Cantidad", "Orden"), Rango_Dias_Mas_Comun=F.col("Orden")),
        metrics(ranked, Unidades_Producto_Mas_Vendido=-F.get("b", F.lit(0))["u"],
                **{f"Producto_Top_{i + 1}": F.get("b", F.lit(i))["ID_Producto"] for i in range(3)},
                **{f"Producto_Top_{i + 1}_Pct": -F.get("b", F.lit(i))["u"] * 100.0 / units for i in range(3)}),
        metrics(pr.pareto_of(product, limit), Productos_Pareto_80=F.col("Productos_Pareto"),
                Productos_Pareto_80_Pct=F.col("Porcentaje_Catalogo")),
        metrics(top(day.groupBy(F.col("DiaSemana_L0").alias("k")).agg(F.sum("v").alias("v")), "v"), Dia_Semana_Top=F.col("k")),
        metrics(top(day.groupBy(F.col("Mes").alias("k")).agg(F.sum("v").alias("v")), "v"), Mes_Top=F.col("k")),
        metrics(top(segments, "n"), Segmento_Tamano_Mayor=F.col("k")),
        metrics(top(stores, "n"), Tienda_Principal=F.col("k"), Tienda_Principal_Pct=F.col("n") * 100.0 / total),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
