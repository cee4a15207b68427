"""Profiling, descriptive statistics and checks.

Each profile is one aggregation pass over the input with one output row
per column (unpivoted on the cluster), never a loop of jobs per column.
Quantiles are exact with linear interpolation as in pandas: ``describe`` and
``boxplot`` find them by distributed selection (``operators.quantiles``), the others keep a
value -> count map per group (basket sizes).  ``approx=True`` switches to ``percentile_approx``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.labels import rnd
from basketry.operators.quantiles import exact_quantiles, join_null_safe

QUARTILES = (0.25, 0.5, 0.75)


def profile_table(df: DataFrame, name: str = "tabla") -> DataFrame:
    """Per column: type, rows, non-null and null counts (one pass)."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("_rows")] + [F.count(F.col(f"`{c}`")).alias(f"_nn{i}") for i, c in enumerate(cols)]
    one = df.agg(*aggs)
    types = dict(df.dtypes)
    entries = [F.struct(F.lit(i).alias("Posicion"), F.lit(c).alias("Columna"), F.lit(types[c]).alias("Tipo"),
                        F.col(f"_nn{i}").alias("No_Nulos")) for i, c in enumerate(cols)]
    out = one.select(F.col("_rows").alias("Filas"), F.inline(F.array(*entries)))
    return out.select(F.lit(name).alias("Tabla"), "Posicion", "Columna", "Tipo", "Filas", "No_Nulos",
                      (F.col("Filas") - F.col("No_Nulos")).alias("Nulos"),
                      F.lit(len(cols)).alias("Num_Columnas"))


def profile_head(df: DataFrame, k: int = 5, order=None) -> DataFrame:
    """First ``k`` rows in key order (deterministic, unlike ``head``)."""
    order = list(order or df.columns)
    return df.orderBy(*order).limit(k)


def duplicate_rows(df: DataFrame, cols=None) -> DataFrame:
    """Rows, distinct rows and duplicates beyond the first (one grouping pass)."""
    cols = list(cols or df.columns)
    g = df.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.sum("n").alias("Filas"), F.count(F.lit(1)).alias("Filas_Distintas"),
                 F.sum(F.col("n") - 1).alias("Duplicados"))


def describe(df: DataFrame, cols, keys=(), approx: bool = False) -> DataFrame:
    """Count, mean, std, min, 25/50/75 %, max per column (and per ``keys``).

    The columns are unpivoted to (Columna, value) rows and described in one
    aggregation, so the input is scanned once whatever the number of columns.
    """
    keys = list(keys)
    long = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        keys, list(cols), "Columna", "_x")
    x, by = F.col("_x"), [*keys, "Columna"]
    plain = long.groupBy(*by).agg(
        F.count(x).alias("Cuenta"), rnd(F.avg(x), 6).alias("Media"), rnd(F.stddev_samp(x), 6).alias("Desv_Std"),
        F.min(x).alias("Minimo"), F.max(x).alias("Maximo"),
        *([F.percentile_approx(x, p, 10000).cast("double").alias(f"q{i}") for i, p in enumerate(QUARTILES)] if approx else []))
    if not approx:
        plain = join_null_safe(plain, exact_quantiles(long, "_x", QUARTILES, by), by, "left")
    return plain.select(*by, "Cuenta", "Media", "Desv_Std", "Minimo", rnd("q0", 6).alias("P25"), rnd("q1", 6).alias("P50"),
                        rnd("q2", 6).alias("P75"), "Maximo")


def basket_stats(baskets: DataFrame, col: str = "Productos_Comprados", keys=()) -> DataFrame:
    """Mean, median, mode (smallest among ties), std of basket sizes."""
    x = F.col(col)
    return baskets.groupBy(*keys).agg(
        F.count(x).alias("Num_Transacciones"),
        rnd(F.avg(x), 6).alias("Media"),
        rnd(F.percentile(x, 0.5), 6).alias("Mediana"),
        F.mode(x, True).alias("Moda"),
        rnd(F.stddev_samp(x), 6).alias("Desv_Std"),
    )


def modes(df: DataFrame, col: str) -> DataFrame:
    """Every most frequent value (pandas ``mode()``), sorted."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    top = counts.agg(F.max("n")).scalar()
    return counts.where(F.col("n") == top).select(col, F.col("n").alias("Frecuencia"))


def boxplot(df: DataFrame, col: str, keys=(), limit: float | None = None) -> DataFrame:
    """Quartiles, IQR, fences, whiskers, outliers and the share above ``limit``.

    Whiskers are the most extreme values still inside the 1.5 IQR fences.
    Two passes: quartiles per group, then a join back for whiskers and
    outlier counts (the group table is small).
    """
    keys = list(keys)
    x = F.col(col)
    q = exact_quantiles(df, col, (0.25, 0.75), keys).withColumnsRenamed({"q0": "_q1", "q1": "_q3"})
    if keys:
        j = df.select(*keys, x.alias("_v")).join(q, keys, "inner")
    else:
        # one group: its quartiles are one row, used as a scalar subquery
        j = df.select(x.alias("_v"), q.select(F.struct("_q1", "_q3")).scalar().alias("_q")).select("_v", "_q._q1", "_q._q3")
    q1, q3 = F.col("_q1"), F.col("_q3")
    iqr = q3 - q1
    lo, hi = q1 - 1.5 * iqr, q3 + 1.5 * iqr
    inside = (F.col("_v") >= lo) & (F.col("_v") <= hi)
    aggs = [
        F.max(q1).alias("Q1"), F.max(q3).alias("Q3"), F.max(iqr).alias("IQR"),
        F.max(lo).alias("Limite_Inf"), F.max(hi).alias("Limite_Sup"),
        F.min(F.when(inside, F.col("_v"))).cast("double").alias("Bigote_Inf"),
        F.max(F.when(inside, F.col("_v"))).cast("double").alias("Bigote_Sup"),
        F.count(F.when(~inside, 1)).alias("Atipicos"),
        F.count(F.lit(1)).alias("Total"),
    ]
    if limit is not None:
        aggs.append(rnd(F.avg((F.col("_v") > limit).cast("int")) * 100.0, 6).alias("Pct_Sobre_Limite"))
    out = j.groupBy(*keys).agg(*aggs)
    return out.withColumn("Pct_Atipicos", rnd(F.try_divide(F.col("Atipicos") * 100.0, F.col("Total")), 6))


def check_integrity(lines: DataFrame, product_category: DataFrame, categories: DataFrame,
                    expected: dict[str, str] | None = None) -> DataFrame:
    """Referential integrity (left-anti join counts) and schema check.

    Rows: (Chequeo, Valor, OK).  Anti joins run on the cluster; only the
    counts come back as rows of the result.
    """
    spark = lines.sparkSession
    no_cat = lines.select("ID_Producto").join(product_category.select("ID_Producto").distinct(), "ID_Producto",
                                              "left_anti")
    orphan_cat = product_category.select("ID_Categoria").join(categories.select("ID_Categoria"), "ID_Categoria",
                                                              "left_anti")
    multi = product_category.groupBy("ID_Producto").agg(F.count_distinct("ID_Categoria").alias("k")) \
        .where(F.col("k") > 1)
    rows = [
        no_cat.agg(F.lit("lineas_sin_categoria").alias("Chequeo"), F.count(F.lit(1)).alias("Valor")),
        orphan_cat.agg(F.lit("categorias_sin_nombre").alias("Chequeo"), F.count(F.lit(1)).alias("Valor")),
        multi.agg(F.lit("productos_multicategoria").alias("Chequeo"), F.count(F.lit(1)).alias("Valor")),
        lines.agg(F.lit("lineas_fecha_nula").alias("Chequeo"),
                  F.count(F.when(F.col("Fecha").isNull(), 1)).alias("Valor")),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    out = out.withColumn("OK", F.col("Valor") == 0)
    if expected is not None:
        actual = dict(lines.dtypes)
        bad = sum(1 for c, t in expected.items() if actual.get(c) != t)
        out = out.unionByName(spark.createDataFrame([("esquema_distinto", bad, bad == 0)], out.schema))
    return out


TOP_RULES, TOP_ITEMSETS = 10, 15  # rows of the verification report


def verify_outputs(stages: dict[str, DataFrame]) -> DataFrame:
    """Counts per stage plus cluster and rule checks; one failure does not stop the rest.

    Returns rows (Etapa, Chequeo, Valor, OK).  Each check is its own small
    aggregate; a stage that does not have the columns it should is reported as a row
    instead of raised.  Failures of the cluster are raised: they say nothing about the data.
    """
    spark = next(iter(stages.values())).sparkSession
    rows = []
    for name, df in stages.items():
        try:
            n = df.count()
            rows.append((name, "filas", float(n), n > 0))
            if "Cluster" in df.columns:
                k = df.select("Cluster").distinct().count()
                rows.append((name, "clusters", float(k), k > 0))
                sizes = df.groupBy("Cluster").count().orderBy("Cluster").collect()  # one row per cluster
                rows.extend((name, f"cluster {r['Cluster']}", float(r["count"]), r["count"] > 0) for r in sizes)
            if "Lift" in df.columns:
                mx = df.agg(F.max("Lift")).first()[0]
                rows.append((name, "lift_max", float(mx) if mx is not None else None, mx is not None))
                best = df.orderBy(F.col("Lift").desc(), "Antecedente_Str", "Consecuente_Str").limit(TOP_RULES).collect()
                rows.extend((name, f"top {i}: {r['Antecedente_Str']} -> {r['Consecuente_Str']}", float(r["Lift"]), True)
                            for i, r in enumerate(best, 1))
            if "freq" in df.columns:
                mx = df.agg(F.max("freq")).first()[0]
                rows.append((name, "freq_max", float(mx) if mx is not None else None, mx is not None))
                text = F.concat_ws(",", F.array_sort("items")).alias("t")
                best = df.select(text, "freq").orderBy(F.col("freq").desc(), "t").limit(TOP_ITEMSETS).collect()
                rows.extend((name, f"top {i}: {r['t']}", float(r["freq"]), True) for i, r in enumerate(best, 1))
        except AnalysisException as exc:
            rows.append((name, f"error: {type(exc).__name__}", None, False))
    return spark.createDataFrame(rows, "Etapa string, Chequeo string, Valor double, OK boolean")
