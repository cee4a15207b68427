"""Baskets as customers: basket table, store summary, purchase gaps, RF
features and bands, size segments (D7, D17, D18, D21, D22, E5-E8, J1-J5).

A basket (transaction) is the customer proxy.  Everything starts from the
basket table, one row per basket key, produced by one partial-aggregated
shuffle of the fact; later steps work on that much smaller table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.labels import cut, rnd

BASKET_KEYS = ("ID_Tienda", "ID_Transaccion")

# Basket-size segments (upper bounds, inclusive) and labels.
SIZE_BOUNDS = (5, 15, 30)
SIZE_LABELS = ("Compra Pequeña (1-5 productos)", "Compra Media (6-15 productos)",
               "Compra Grande (16-30 productos)", "Compra Muy Grande (>30 productos)")

# RF bands (right-closed bins) and labels.
RECENCY_BINS = (0, 30, 60, 90, float("inf"))
RECENCY_LABELS = ("Muy Reciente (<30d)", "Reciente (30-60d)", "Moderado (60-90d)", "Antiguo (>90d)")
UNITS_BINS = (0, 5, 15, 30, float("inf"))
UNITS_LABELS = ("Baja (1-5)", "Media (6-15)", "Alta (16-30)", "Muy Alta (>30)")

# Purchase-gap ranges (inclusive bounds) and labels.
GAP_RANGES = (("Mismo día (0 días)", 0, 0), ("1 día", 1, 1), ("2-7 días", 2, 7),
              ("8-14 días", 8, 14), ("15-30 días", 15, 30), ("Más de 30 días", 31, None))


def basket_table(sales: DataFrame, keys=BASKET_KEYS) -> DataFrame:
    """Units, purchase date and store per basket.

    ``min`` replaces the reference's order-dependent ``first``; a basket has
    one date and one store, so both agree on clean data.
    """
    keys = list(keys)
    aggs = [F.count(F.lit(1)).alias("Productos_Comprados"), F.min("Fecha").alias("Fecha_Compra")]
    if "ID_Tienda" not in keys:
        aggs.append(F.min("ID_Tienda").alias("Tienda"))
    out = sales.groupBy(*keys).agg(*aggs)
    if "ID_Tienda" in keys:
        out = out.withColumn("Tienda", F.col("ID_Tienda"))
    return out


def largest_baskets(sales: DataFrame, n: int = 10, keys=BASKET_KEYS) -> DataFrame:
    """D7 + F2: the ``n`` largest baskets (ties: smallest transaction id, then store)."""
    b = basket_table(sales, keys).select("ID_Transaccion", F.col("Productos_Comprados").alias("Num_Productos"),
                                         F.col("Fecha_Compra").alias("Fecha"), "Tienda")
    return b.orderBy(F.col("Num_Productos").desc(), F.col("ID_Transaccion").asc(), F.col("Tienda").asc()).limit(n)


def store_units(sales: DataFrame) -> DataFrame:
    """Units per store."""
    return sales.groupBy("ID_Tienda").agg(F.count(F.lit(1)).alias("Unidades_Vendidas"))


def store_summary(sales: DataFrame) -> DataFrame:
    """Per store: baskets, mean and total units, share of baskets, rank.

    Two-level aggregate (basket, then store); the share and rank windows run
    on the store-sized table only.
    """
    b = basket_table(sales)
    s = b.groupBy("Tienda").agg(
        F.count(F.lit(1)).alias("Total_Transacciones"),
        rnd(F.avg("Productos_Comprados"), 2).alias("Promedio_Productos_Transaccion"),
        F.sum("Productos_Comprados").alias("Total_Productos_Vendidos"))
    w = Window.partitionBy(F.lit(0))
    return (s.withColumn("Participacion_Pct",
                         rnd(F.col("Total_Transacciones") * 100.0 / F.sum("Total_Transacciones").over(w), 2))
            .withColumn("Ranking", F.rank().over(w.orderBy(F.col("Total_Transacciones").desc()))))


def basket_size_hist(baskets: DataFrame, col: str = "Productos_Comprados") -> DataFrame:
    """Basket size -> number of baskets, sorted by size."""
    return baskets.groupBy(F.col(col).alias("Tamano")).agg(F.count(F.lit(1)).alias("Num_Transacciones"))


def monthly_baskets(baskets: DataFrame) -> DataFrame:
    """Mean number of baskets per month."""
    per = baskets.groupBy(F.date_format("Fecha_Compra", "yyyy-MM").alias("Periodo")).agg(
        F.count(F.lit(1)).alias("n"))
    return per.agg(F.count(F.lit(1)).alias("Meses"),
                   rnd(F.avg("n"), 6).alias("Promedio_Transacciones_Mes"))


def purchase_gaps(baskets: DataFrame, keys=(), date: str = "Fecha_Compra") -> DataFrame:
    """E5: days between consecutive purchases as a weighted table (Dias, Peso).

    Sorting all baskets by date and differencing gives, for a date with n
    baskets, n-1 zero gaps and one gap to the previous date (none for the
    first date).  So baskets are counted per date and only the per-date
    table (calendar sized) is ordered: no global sort of baskets.
    """
    keys = list(keys)
    per_day = baskets.groupBy(*keys, date).agg(F.count(F.lit(1)).alias("n"))
    w = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy(date)
    prev = F.lag(date).over(w)
    d = per_day.select(*keys, "n", F.datediff(F.col(date), prev).alias("gap"))
    zeros = d.where(F.col("n") > 1).select(*keys, F.lit(0).alias("Dias"), (F.col("n") - 1).alias("Peso"))
    jumps = d.where(F.col("gap").isNotNull()).select(*keys, F.col("gap").alias("Dias"), F.lit(1).cast("long").alias("Peso"))
    out = zeros.unionByName(jumps)
    return out.groupBy(*keys, "Dias").agg(F.sum("Peso").alias("Peso"))


def gap_stats(gaps: DataFrame, quantiles=(0.25, 0.5, 0.75, 0.9), keys=()) -> DataFrame:
    """Weighted mean, sample std, min, max and exact quantiles (linear interpolation)."""
    keys = list(keys)
    n = F.sum("Peso")
    s1 = F.sum(F.col("Dias") * F.col("Peso"))
    s2 = F.sum(F.col("Dias") * F.col("Dias") * F.col("Peso"))
    aggs = [
        n.alias("Num_Intervalos"),
        rnd(s1 / n, 6).alias("Media"),
        rnd(F.sqrt(F.try_divide(s2 - s1 * s1 / n, n - 1)), 6).alias("Desv_Std"),  # null for one gap
        F.min("Dias").alias("Minimo"),
        F.max("Dias").alias("Maximo"),
    ]
    for q in quantiles:
        aggs.append(rnd(F.percentile(F.col("Dias"), q, F.col("Peso")), 6).alias(f"P{int(round(q * 100))}"))
    return gaps.groupBy(*keys).agg(*aggs)


def gap_ranges(gaps: DataFrame, keys=()) -> DataFrame:
    """Gaps per range (0, 1, 2-7, 8-14, 15-30, >30) with % of all gaps."""
    keys = list(keys)
    rows = []
    for i, (label, lo, hi) in enumerate(GAP_RANGES):
        cond = (F.col("Dias") >= lo) if hi is None else F.col("Dias").between(lo, hi)
        rows.append(F.struct(F.lit(i).alias("Orden"), F.lit(label).alias("Rango"),
                             F.sum(F.when(cond, F.col("Peso")).otherwise(0)).alias("Cantidad")))
    agg = gaps.groupBy(*keys).agg(F.array(*rows).alias("r"), F.sum("Peso").alias("_t"))
    out = agg.select(*keys, "_t", F.inline("r"))
    return out.select(*keys, "Orden", "Rango", "Cantidad",
                      rnd(F.col("Cantidad") * 100.0 / F.col("_t"), 6).alias("Porcentaje"))


def gap_cdf(gaps: DataFrame, keys=()) -> DataFrame:
    """Cumulative % of all gaps up to each distinct gap value (a plot may stop where it likes)."""
    keys = list(keys)
    g = gaps
    w = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    return g.select(*keys, "Dias", F.col("Peso").alias("Frecuencia"),
                    F.sum("Peso").over(w.orderBy("Dias").rowsBetween(Window.unboundedPreceding, 0)).alias("Acumulado"),
                    F.sum("Peso").over(w).alias("_t")).select(
        *keys, "Dias", "Frecuencia", "Acumulado",
        rnd(F.col("Acumulado") * 100.0 / F.col("_t"), 6).alias("Porcentaje_Acumulado"))


def as_of_date(sales: DataFrame) -> Column:
    """Q9 default reference date: last date + 1, as a scalar subquery."""
    return sales.agg(F.date_add(F.max("Fecha"), 1)).scalar()


def rf_features(sales: DataFrame, keys=BASKET_KEYS, as_of=None) -> DataFrame:
    """Recency (days to ``as_of``) and units per basket key.

    ``as_of`` defaults to the last date + 1 (never the current date).
    """
    ref = F.lit(as_of) if as_of is not None and not isinstance(as_of, Column) else as_of
    if ref is None:
        ref = as_of_date(sales)
    return sales.groupBy(*keys).agg(
        F.datediff(ref, F.max("Fecha")).alias("Recencia_Dias"),
        F.count(F.lit(1)).alias("Productos_Comprados"),
        F.count_distinct("ID_Producto").alias("Productos_Distintos"))


def rf_labels(rf: DataFrame) -> DataFrame:
    """Right-closed recency and units bands and the combined segment text."""
    return rf.withColumns({
        "Recencia_Categoria": cut(F.col("Recencia_Dias"), RECENCY_BINS, RECENCY_LABELS),
        "Frecuencia_Categoria": cut(F.col("Productos_Comprados"), UNITS_BINS, UNITS_LABELS),
    }).withColumn("Segmento_RFM", F.concat_ws(" / ", F.coalesce(F.col("Recencia_Categoria"), F.lit("nan")),
                                              F.coalesce(F.col("Frecuencia_Categoria"), F.lit("nan"))))


def rfm_bands(rf: DataFrame) -> DataFrame:
    """Counts per recency band and per units band (band order kept)."""
    lab = rf_labels(rf)
    rec = lab.groupBy(F.lit("Recencia").alias("Dimension"), F.col("Recencia_Categoria").alias("Banda")).count()
    uni = lab.groupBy(F.lit("Frecuencia").alias("Dimension"), F.col("Frecuencia_Categoria").alias("Banda")).count()
    return rec.unionByName(uni).withColumnRenamed("count", "Num_Transacciones")


def rfm_segments(rf: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` combined segments (ties: segment text)."""
    seg = rf_labels(rf).groupBy("Segmento_RFM").agg(F.count(F.lit(1)).alias("Num_Transacciones"))
    return seg.orderBy(F.col("Num_Transacciones").desc(), F.col("Segmento_RFM").asc()).limit(n)


def crosstab(df: DataFrame, row: str, col: str, values, names=None) -> DataFrame:
    """Counts of ``row`` x ``col`` with a fixed column list (zero fill)."""
    names = list(names or values)
    piv = df.groupBy(row).pivot(col, list(values)).agg(F.count(F.lit(1)))
    return piv.select(row, *[F.coalesce(F.col(f"`{v}`"), F.lit(0)).cast("long").alias(n)
                             for v, n in zip(values, names)])


def size_segments(baskets: DataFrame, col: str = "Productos_Comprados") -> DataFrame:
    """Basket-size segments: count, %, mean, median, min, max."""
    c = F.col(col)
    seg = F.when(c <= SIZE_BOUNDS[0], SIZE_LABELS[0]).when(c <= SIZE_BOUNDS[1], SIZE_LABELS[1]) \
        .when(c <= SIZE_BOUNDS[2], SIZE_LABELS[2]).otherwise(SIZE_LABELS[3])
    total = baskets.agg(F.count(F.lit(1))).scalar()
    return baskets.groupBy(seg.alias("Segmento_Tamano")).agg(
        F.count(F.lit(1)).alias("Total_Transacciones"),
        rnd(F.avg(c), 6).alias("Promedio"),
        rnd(F.median(c), 6).alias("Mediana"),
        F.min(c).alias("Minimo"),
        F.max(c).alias("Maximo"),
    ).withColumn("Porcentaje", rnd(F.col("Total_Transacciones") * 100.0 / total, 6))
