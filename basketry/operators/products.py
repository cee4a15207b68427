"""Product, category and store rankings.

Rankings aggregate on the cluster (partial aggregation on every task), then
take the top rows with ``orderBy(...).limit(n)``, which Spark plans as a
per-partition top-k plus one small merge (``TakeOrderedAndProject``).
Ties always break on the key, so results do not depend on partitioning.
Totals for shares are scalar subqueries (``DataFrame.scalar()``), planned
lazily with the query; nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.labels import rnd

BASKET_KEYS = ("ID_Tienda", "ID_Transaccion")  # what a transaction is



def product_counts(sales: DataFrame, measure: str = "units", approx: bool = False) -> DataFrame:
    """Per product: units (rows) or reach (distinct transactions), plus one category.

    ``approx=True`` counts reach with HyperLogLog++ (``approx_count_distinct``,
    fixed memory per product) instead of the exact distinct aggregate.
    """
    if measure == "units":
        value = F.count(F.lit(1)).alias("Unidades_Vendidas")
    elif measure == "reach":
        value = (F.approx_count_distinct(F.struct(*BASKET_KEYS)) if approx
                 else F.count_distinct(*BASKET_KEYS)).alias("Num_Transacciones")
    else:
        raise ValueError(f"measure must be 'units' or 'reach', got {measure!r}")
    return sales.groupBy("ID_Producto").agg(value, F.min("Nombre_Categoria").alias("Nombre_Categoria"))


def _ranked(df: DataFrame, value: str, key: str, n: int, ascending: bool = False) -> DataFrame:
    order = [F.col(value).asc() if ascending else F.col(value).desc(), F.col(key).asc()]
    top = df.orderBy(*order).limit(n)
    return top.withColumn("Posicion", F.row_number().over(Window.orderBy(*order)))


def top_products(sales: DataFrame, n: int = 10, measure: str = "units", share: bool = False,
                 approx: bool = False) -> DataFrame:
    """D3/D4 + C5 + F1/F2 (+ D6/E12 with ``share``)."""
    counts = product_counts(sales, measure, approx)
    value = "Unidades_Vendidas" if measure == "units" else "Num_Transacciones"
    out = _ranked(counts, value, "ID_Producto", n)
    cols = ["Posicion", "ID_Producto", "Nombre_Categoria", value]
    if share:
        if measure == "units":
            total = sales.agg(F.count(F.lit(1))).scalar()
        else:
            total = sales.agg(F.count_distinct(*BASKET_KEYS)).scalar()
        out = out.withColumn("Porcentaje", rnd(F.col(value) * 100.0 / total, 6))
        cols.append("Porcentaje")
    return out.select(*cols)


def top_n(sales: DataFrame, key: str = "ID_Producto", n: int = 10, measure: str = "units",
          share: bool = False, ascending: bool = False) -> DataFrame:
    """F1/F2/F6 for any key (product, category, store): units or reach, ties on the key.

    ``measure='units'`` counts rows, ``'reach'`` distinct transactions;
    ``share`` adds the % of the total as a scalar subquery.
    """
    if measure == "units":
        value, agg = "Unidades_Vendidas", F.count(F.lit(1))
        total = sales.agg(F.count(F.lit(1))).scalar() if share else None
    elif measure == "reach":
        value, agg = "Num_Transacciones", F.count_distinct(*BASKET_KEYS)
        total = sales.agg(F.count_distinct(*BASKET_KEYS)).scalar() if share else None
    else:
        raise ValueError(f"measure must be 'units' or 'reach', got {measure!r}")
    counts = sales.groupBy(key).agg(agg.alias(value))
    out = _ranked(counts, value, key, n, ascending=ascending).select("Posicion", key, value)
    if share:
        out = out.withColumn("Porcentaje", rnd(F.col(value) * 100.0 / total, 6))
    return out


def bottom_n(sales: DataFrame, key: str = "ID_Producto", n: int = 10, measure: str = "units") -> DataFrame:
    """F6 for any key: the ``n`` smallest (ties on the key)."""
    return top_n(sales, key, n, measure, ascending=True)


def bottom_products(sales: DataFrame, n: int = 10) -> DataFrame:
    """least sold products (ties on the smallest id)."""
    counts = product_counts(sales, "units")
    return _ranked(counts, "Unidades_Vendidas", "ID_Producto", n, ascending=True).select(
        "Posicion", "ID_Producto", "Nombre_Categoria", "Unidades_Vendidas")


def top_categories(sales: DataFrame, n: int = 10, share: bool = True) -> DataFrame:
    """D5 (+ D6): units and distinct products per category, top ``n``."""
    counts = sales.groupBy("Nombre_Categoria").agg(
        F.count(F.lit(1)).alias("Unidades_Vendidas"),
        F.count_distinct("ID_Producto").alias("Num_Productos"))
    out = _ranked(counts, "Unidades_Vendidas", "Nombre_Categoria", n)
    cols = ["Posicion", "Nombre_Categoria", "Unidades_Vendidas", "Num_Productos"]
    if share:
        total = sales.agg(F.count(F.lit(1))).scalar()
        out = out.withColumn("Porcentaje", rnd(F.col("Unidades_Vendidas") * 100.0 / total, 6))
        cols.append("Porcentaje")
    return out.select(*cols)


def top_per_store(sales: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` products per store; Spark plans a per-group limit before the sort."""
    counts = sales.groupBy("ID_Tienda", "ID_Producto").agg(F.count(F.lit(1)).alias("Unidades_Vendidas"))
    w = Window.partitionBy("ID_Tienda").orderBy(F.col("Unidades_Vendidas").desc(), F.col("ID_Producto").asc())
    return (counts.withColumn("Posicion", F.row_number().over(w))
            .where(F.col("Posicion") <= n)
            .select("ID_Tienda", "Posicion", "ID_Producto", "Unidades_Vendidas"))


def top_plus_others(sales: DataFrame, n: int = 15) -> DataFrame:
    """top ``n`` products plus one 'Otros' row holding the remainder."""
    counts = sales.groupBy("ID_Producto").agg(F.count(F.lit(1)).alias("Unidades_Vendidas"))
    top = _ranked(counts, "Unidades_Vendidas", "ID_Producto", n).select(
        "Posicion", F.col("ID_Producto").cast("string").alias("Producto"), "Unidades_Vendidas")
    total = sales.agg(F.count(F.lit(1))).scalar()
    rest = top.agg(F.coalesce(F.sum("Unidades_Vendidas"), F.lit(0)).alias("_top")).select(
        (total - F.col("_top")).alias("Unidades_Vendidas"))
    others = rest.where(F.col("Unidades_Vendidas") > 0).select(
        F.lit(n + 1).alias("Posicion"), F.lit("Otros").alias("Producto"), "Unidades_Vendidas")
    return top.unionByName(others)


def pareto(sales: DataFrame, limit: float = 0.8, keys=()) -> DataFrame:
    """Products needed to reach ``limit`` of units, per ``keys`` group.

    Histogram compression: products are grouped by their unit count (at most
    sqrt(2N) distinct counts for N units), and the cumulative sum runs over
    those count levels only.  With counts descending and ``before`` units in
    higher levels, a level of ``h`` products of ``c`` units adds
    ``min(h, floor((limit*N - before) / c))`` products, floored at 0: the
    product whose units would cross the limit is not counted.
    """
    keys = list(keys)
    return pareto_of(sales.groupBy(*keys, "ID_Producto").agg(F.count(F.lit(1)).alias("u")), limit, keys)


def pareto_of(per_product: DataFrame, limit: float = 0.8, keys=()) -> DataFrame:
    """``pareto`` from units per product: (keys, ID_Producto, u)."""
    keys = list(keys)
    levels = per_product.groupBy(*keys, "u").agg(F.count(F.lit(1)).alias("h"))
    w_all = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    w_cum = w_all.orderBy(F.col("u").desc()).rowsBetween(Window.unboundedPreceding, -1)
    lv = (levels.withColumn("N", F.sum(F.col("u") * F.col("h")).over(w_all))
          .withColumn("P", F.sum("h").over(w_all))
          .withColumn("before", F.coalesce(F.sum(F.col("u") * F.col("h")).over(w_cum), F.lit(0))))
    take = F.greatest(F.lit(0), F.least(F.col("h"),
                                        F.floor((F.lit(limit) * F.col("N") - F.col("before")) / F.col("u"))))
    out = lv.groupBy(*keys).agg(
        F.sum(take).cast("long").alias("Productos_Pareto"),
        F.max("P").alias("Productos_Total"),
        F.max("N").alias("Unidades_Total"))
    return out.withColumn("Porcentaje_Catalogo",
                          rnd(F.col("Productos_Pareto") * 100.0 / F.col("Productos_Total"), 6))


def pareto_curve(sales: DataFrame, keys=()) -> DataFrame:
    """E9 curve at count-level resolution, per ``keys`` group.

    One row per distinct units-per-product level (descending): products in
    the level, cumulative products and cumulative % of units at the end of
    the level.  The product-level curve is a straight line inside a level,
    so these points are exact; the row count grows like sqrt(units), not
    with the catalogue, and no group is sorted in one task.
    """
    keys = list(keys)
    per_product = sales.groupBy(*keys, "ID_Producto").agg(F.count(F.lit(1)).alias("u"))
    levels = per_product.groupBy(*keys, "u").agg(F.count(F.lit(1)).alias("Num_Productos"))
    w = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    wc = w.orderBy(F.col("u").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return levels.select(
        *keys, F.col("u").alias("Unidades_Por_Producto"), "Num_Productos",
        F.sum("Num_Productos").over(wc).alias("Productos_Acumulados"),
        rnd(F.sum(F.col("u") * F.col("Num_Productos")).over(wc) * 100.0
                / F.sum(F.col("u") * F.col("Num_Productos")).over(w), 6).alias("Porcentaje_Acumulado"))


def pareto_ranks(sales: DataFrame, bucket: int = 4096) -> DataFrame:
    """E9 per product: rank by units (ties: smaller id first) and cumulative % of units.

    Exact without ordering the catalogue in one task.  Products are grouped
    into count levels (units per product, descending) and, inside a level,
    into id buckets of at most ``bucket`` ids.  A product's rank is the
    number of products in higher levels + in earlier buckets of its level +
    its row number inside its bucket; only the small (level, bucket) count
    table is ordered globally, and the widest window partition holds one
    bucket.  Cumulative units follow from the rank: units of higher levels
    plus ``u`` times the position inside the level.
    """
    per = sales.groupBy("ID_Producto").agg(F.count(F.lit(1)).alias("u"))
    per = per.withColumn("_b", F.floor(F.col("ID_Producto") / bucket))
    cells = per.groupBy("u", "_b").agg(F.count(F.lit(1)).alias("_c"))
    w_lvl = Window.partitionBy(F.lit(0)).orderBy(F.col("u").desc())
    levels = (cells.groupBy("u").agg(F.sum("_c").alias("_h"))
              .withColumn("_before_p", F.coalesce(F.sum("_h").over(w_lvl.rowsBetween(Window.unboundedPreceding, -1)),
                                                  F.lit(0)))
              .withColumn("_before_u", F.coalesce(
                  F.sum(F.col("_h") * F.col("u")).over(w_lvl.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("_n", F.sum(F.col("_h") * F.col("u")).over(Window.partitionBy(F.lit(0)))))
    w_cell = Window.partitionBy("u").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("_cell_off", F.coalesce(F.sum("_c").over(w_cell), F.lit(0)))
    w_in = Window.partitionBy("u", "_b").orderBy("ID_Producto")
    ranked = (per.join(cells, ["u", "_b"]).join(levels, "u")
              .withColumn("_k", F.col("_cell_off") + F.row_number().over(w_in)))
    return ranked.select(
        "ID_Producto", F.col("u").alias("Unidades_Vendidas"),
        (F.col("_before_p") + F.col("_k")).alias("Posicion"),
        rnd((F.col("_before_u") + F.col("u") * F.col("_k")) * 100.0 / F.col("_n"), 6).alias("Porcentaje_Acumulado"))


def catalog_counts(catalog: DataFrame) -> DataFrame:
    """Products per category in the catalogue and their share.

    The per-category id list of the reference is not collected into one
    row (a category can hold a third of the catalogue); ``distinct_values``
    gives the distinct (category, product) pairs as a distributed frame.
    """
    total = catalog.agg(F.count_distinct("ID_Producto")).scalar()
    return catalog.groupBy("Nombre_Categoria").agg(
        F.count(F.lit(1)).alias("Filas"),
        F.count_distinct("ID_Producto").alias("Num_Productos"),
        F.min("ID_Producto").alias("Producto_Min"),
        F.max("ID_Producto").alias("Producto_Max"),
    ).withColumn("Porcentaje", rnd(F.col("Num_Productos") * 100.0 / total, 6))


def distinct_values(df: DataFrame, *cols: str) -> DataFrame:
    """Distinct values (or tuples) of columns, sorted; stays distributed."""
    return df.select(*cols).distinct().orderBy(*cols)
