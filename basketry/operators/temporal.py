"""Calendar aggregates and time-series operators (D8-D16, D23-D25, D27,
E1-E4, E11, E13, E14).

Rule for every ordered operator here: aggregate on the cluster first (to
calendar size: days, weeks, months), then order the small result.  Every
operator accepts ``keys`` so many series (per store, category, product)
run as one job with ``Window.partitionBy(*keys)``.  Without keys a window
is a single task, which is only acceptable because its input is already
reduced to one row per calendar period.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions import calendar as cal
from basketry.functions.labels import rnd

_PERIODS = ("day", "week", "month", "year")


def _period_col(period: str) -> tuple[str, Column]:
    if period == "day":
        return "Fecha", F.col("Fecha")
    if period == "week":
        return "Periodo", cal.week_label("Fecha")
    if period == "month":
        return "Periodo", cal.month_period("Fecha")
    if period == "year":
        return "Anio", F.year("Fecha")
    raise ValueError(f"period must be one of {_PERIODS}")


def _win(keys) -> Window:
    keys = list(keys)
    return Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))


def _dated(sales: DataFrame) -> DataFrame:
    """Lines with a date (an unparsable raw date is null and has no period)."""
    return sales.where(F.col("Fecha").isNotNull())


def period_sales(sales: DataFrame, period: str = "day", keys=()) -> DataFrame:
    """Units, distinct transactions, active stores per period."""
    name, expr = _period_col(period)
    return _dated(sales).groupBy(*keys, expr.alias(name)).agg(
        F.count(F.lit(1)).alias("Total_Productos_Vendidos"),
        F.count_distinct("ID_Tienda", "ID_Transaccion").alias("Numero_Transacciones"),
        F.count_distinct("ID_Tienda").alias("Tiendas_Activas"),
    )


def by_weekday(sales: DataFrame) -> DataFrame:
    """Units and transactions per weekday, Monday..Sunday, absent days kept as 0."""
    agg = _dated(sales).groupBy(F.col("DiaSemana_L0").alias("Dia_Num")).agg(
        F.count(F.lit(1)).alias("Total_Productos"),
        F.count_distinct("ID_Tienda", "ID_Transaccion").alias("Numero_Transacciones"))
    days = sales.sparkSession.range(7).select(
        F.col("id").cast("int").alias("Dia_Num"),
        F.element_at(F.array(*[F.lit(n) for n in cal.DAY_NAMES_ES]), F.col("id").cast("int") + 1).alias("Dia"))
    return (days.join(agg, "Dia_Num", "left")
            .fillna({"Total_Productos": 0, "Numero_Transacciones": 0})
            .select("Dia_Num", "Dia", "Total_Productos", "Numero_Transacciones"))


def by_month(sales: DataFrame) -> DataFrame:
    """Units and transactions per calendar month over all years, Spanish names."""
    return (_dated(sales).groupBy("Mes").agg(
        F.count(F.lit(1)).alias("Total_Productos"),
        F.count_distinct("ID_Tienda", "ID_Transaccion").alias("Numero_Transacciones"))
        .withColumn("Nombre_Mes", cal.month_name_es(F.col("Mes"))))


def extremes(df: DataFrame, key: str, value: str, label: str | None = None) -> DataFrame:
    """Best and worst ``key`` by ``value``; ties go to the smallest key."""
    label = label or key
    w_best = df.orderBy(F.col(value).desc(), F.col(key).asc()).limit(1).select(
        F.lit(label).alias("Serie"), F.lit("MAX").alias("Extremo"),
        F.col(key).cast("string").alias("Clave"), F.col(value).cast("double").alias("Valor"))
    w_worst = df.orderBy(F.col(value).asc(), F.col(key).asc()).limit(1).select(
        F.lit(label).alias("Serie"), F.lit("MIN").alias("Extremo"),
        F.col(key).cast("string").alias("Clave"), F.col(value).cast("double").alias("Valor"))
    return w_best.unionByName(w_worst)


def heatmap(sales: DataFrame, row: str, col: str, values, rows=None, prefix: str = "C",
            measure: str = "units") -> DataFrame:
    """D14/D15 generic: ``row`` x ``col`` counts with a fixed column list and zero fill.

    ``rows`` (optional) is a fixed list of row values kept even when absent
    (a small literal dimension left-joined with the pivot).
    """
    agg = F.count(F.lit(1)) if measure == "units" else F.count_distinct("ID_Tienda", "ID_Transaccion")
    values = list(values)
    piv = sales.groupBy(row).pivot(col, values).agg(agg)
    if rows is not None:
        dim = sales.sparkSession.createDataFrame([(r,) for r in rows], [row])
        piv = dim.join(piv, row, "left")
    return piv.select(row, *[F.coalesce(F.col(f"`{v}`"), F.lit(0)).cast("long").alias(f"{prefix}{v}")
                             for v in values])


def heatmap_dow_hour(sales: DataFrame) -> DataFrame:
    """rows = weekday 1..7 (1 = Sunday), columns H00..H23, zero fill."""
    hours = list(range(cal.HOURS_PER_DAY))
    piv = _dated(sales).groupBy("DiaSemana").pivot("Hora", hours).agg(F.count(F.lit(1)))
    days = sales.sparkSession.range(1, 8).select(F.col("id").cast("int").alias("DiaSemana"))
    out = days.join(piv, "DiaSemana", "left")
    return out.select("DiaSemana", *[F.coalesce(F.col(str(h)), F.lit(0)).cast("long").alias(f"H{h:02d}")
                                     for h in hours])


def heatmap_week_dow(sales: DataFrame) -> DataFrame:
    """rows = ISO week, columns D0..D6 (0 = Monday), zero fill."""
    days = list(range(7))
    piv = _dated(sales).groupBy("Semana_Anio").pivot("DiaSemana_L0", days).agg(F.count(F.lit(1)))
    return piv.select("Semana_Anio", *[F.coalesce(F.col(str(d)), F.lit(0)).cast("long").alias(f"D{d}")
                                       for d in days])


def weekday_peak_hour(sales: DataFrame) -> DataFrame:
    """Per weekday, the hour with most transactions (ties: earliest hour) and % of the day."""
    per = _dated(sales).groupBy("DiaSemana", "Hora").agg(F.count_distinct("ID_Tienda", "ID_Transaccion").alias("t"))
    return per.groupBy("DiaSemana").agg(
        F.max_by("Hora", F.struct(F.col("t"), -F.col("Hora"))).alias("Hora_Pico"),
        F.max("t").alias("Transacciones_Pico"),
        F.sum("t").alias("Transacciones_Dia"),
    ).withColumn("Porcentaje_Pico", rnd(F.col("Transacciones_Pico") * 100.0 / F.col("Transacciones_Dia"), 6))


def weekday_uplift(sales: DataFrame) -> DataFrame:
    """Mean daily units per weekday vs mean over all days, in %.

    Days are the dates present in the data (the reference averages its daily
    table, so absent dates are not zeros).
    """
    daily = period_sales(sales, "day").select(
        "Fecha", "Total_Productos_Vendidos", F.dayofweek("Fecha").alias("DiaSemana"))
    overall = daily.agg(F.avg("Total_Productos_Vendidos")).scalar()
    return daily.groupBy("DiaSemana").agg(
        F.count(F.lit(1)).alias("Dias"),
        rnd(F.avg("Total_Productos_Vendidos"), 6).alias("Promedio_Diario"),
    ).withColumn("Uplift_Pct", rnd((F.col("Promedio_Diario") / overall - 1.0) * 100.0, 6))


def weekend_hour_profile(sales: DataFrame) -> DataFrame:
    """Share of units per hour, weekdays vs weekend (Saturday, Sunday), in %.

    One aggregate over (day type, hour); the per-type totals are a window
    over that 48-row table.
    """
    kind = F.when(F.col("DiaSemana").isin(1, 7), "Fin de semana").otherwise("Entre semana")
    per = _dated(sales).groupBy(kind.alias("Tipo_Dia"), "Hora").agg(F.count(F.lit(1)).alias("Unidades"))
    total = F.sum("Unidades").over(Window.partitionBy("Tipo_Dia"))
    return per.withColumn("Porcentaje", rnd(F.col("Unidades") * 100.0 / total, 6))


def period_summary(sales: DataFrame, stage=None) -> DataFrame:
    """Mean, max, min, sample std of units per day / week / month.

    The fact is read once, for units per (date, store, transaction); ``stage``
    (frame, name -> frame) writes that table and the three periods are taken from it.
    """
    base = _dated(sales).groupBy("Fecha", "ID_Tienda", "ID_Transaccion").agg(F.count(F.lit(1)).alias("_u"))
    base = stage(base, "basket-days") if stage else base
    parts = []
    for label, period in (("Diario", "day"), ("Semanal", "week"), ("Mensual", "month")):
        name, expr = _period_col(period)
        p = base.groupBy(expr.alias(name)).agg(
            F.sum("_u").alias("Total_Productos_Vendidos"),
            F.count_distinct("ID_Tienda", "ID_Transaccion").alias("Numero_Transacciones"))
        parts.append(p.agg(
            F.lit(label).alias("Periodo"),
            F.count(F.lit(1)).alias("Num_Periodos"),
            rnd(F.avg("Total_Productos_Vendidos"), 6).alias("Promedio"),
            F.max("Total_Productos_Vendidos").alias("Maximo"),
            F.min("Total_Productos_Vendidos").alias("Minimo"),
            rnd(F.stddev_samp("Total_Productos_Vendidos"), 6).alias("Desv_Std"),
            rnd(F.avg("Numero_Transacciones"), 6).alias("Promedio_Transacciones"),
        ))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def moving_average(series: DataFrame, value: str = "Total_Productos_Vendidos", order: str = "Fecha",
                   windows=(7, 14, 30), keys=()) -> DataFrame:
    """Trailing k-row mean, null until k rows exist (pandas ``rolling(k)``)."""
    w = _win(keys).orderBy(order)
    cols = {}
    for k in windows:
        wk = w.rowsBetween(-(k - 1), 0)
        cols[f"MA_{k}"] = F.when(F.count(F.col(value)).over(wk) == k, rnd(F.avg(value).over(wk), 6))
    return series.withColumns(cols)


def growth(series: DataFrame, values=("Total_Productos_Vendidos", "Numero_Transacciones"),
           order: str = "Periodo", keys=(), names=None) -> DataFrame:
    """Period-over-period change in % (first period null)."""
    w = _win(keys).orderBy(order)
    names = names or [f"Crecimiento_{v}" for v in values]
    cols = {}
    for v, n in zip(values, names):
        prev = F.lag(v).over(w)
        cols[n] = rnd(F.try_divide((F.col(v) - prev) * 100.0, prev), 6)
    return series.withColumns(cols)


def trend_verdict(series: DataFrame, value: str = "Total_Productos_Vendidos", order: str = "Periodo",
                  keys=()) -> DataFrame:
    """First vs last period change and CRECIENTE / DECRECIENTE / ESTABLE."""
    out = series.groupBy(*keys).agg(
        F.min_by(value, order).alias("Primero"),
        F.max_by(value, order).alias("Ultimo"))
    change = rnd((F.col("Ultimo") - F.col("Primero")) * 100.0 / F.col("Primero"), 6)
    return out.withColumn("Cambio_Pct", change).withColumn(
        "Tendencia", F.when(F.col("Cambio_Pct") > 0, "CRECIENTE")
        .when(F.col("Cambio_Pct") < 0, "DECRECIENTE").otherwise("ESTABLE"))


def fill_forward(series: DataFrame, cols, order: str = "Fecha", keys=()) -> DataFrame:
    """Carry the last non-null value forward."""
    w = _win(keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return series.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})


def complete_days(series: DataFrame, order: str = "Fecha", keys=()) -> DataFrame:
    """Calendar with every day between the first and last date of each series.

    The day grid is generated per series from its own min/max (bounded by the
    calendar span), then left-joined with the series.
    """
    keys = list(keys)
    span = series.groupBy(*keys).agg(F.min(order).alias("_d0"), F.max(order).alias("_d1"))
    grid = span.select(*keys, F.explode(F.sequence("_d0", "_d1")).alias(order))
    return grid.join(series, [*keys, order], "left")


def seasonal_decompose(series: DataFrame, value: str = "Total_Productos_Vendidos", order: str = "Fecha",
                       period: int = 7, keys=()) -> DataFrame:
    """Additive decomposition (trend, seasonal, residual), classical method.

    Trend is the centred moving average of ``period`` rows (for even periods,
    the 2 x period average with half weights at both ends), null where the
    window does not fit.  Seasonal is the mean detrended value per row
    position modulo ``period``, centred to mean zero.  Position, not weekday,
    defines the phase, as in the published method.
    """
    keys = list(keys)
    w = _win(keys).orderBy(order)
    half = period // 2
    pos = F.row_number().over(w) - 1
    df = series.withColumn("_pos", pos)
    wp = _win(keys).orderBy("_pos")
    if period % 2:
        wt = wp.rowsBetween(-half, half)
        trend = F.when(F.count(F.col(value)).over(wt) == period, F.avg(value).over(wt))
    else:
        wt = wp.rowsBetween(-half, half)
        inner = wp.rowsBetween(-half + 1, half - 1)
        full = F.count(F.col(value)).over(wt) == period + 1
        trend = F.when(full, (F.sum(value).over(inner)
                              + 0.5 * F.lag(value, half).over(wp)
                              + 0.5 * F.lead(value, half).over(wp)) / period)
    df = df.withColumn("Tendencia", trend).withColumn("_phase", F.pmod(F.col("_pos"), F.lit(period)))
    phase = (df.groupBy(*keys, "_phase").agg(F.avg(F.col(value) - F.col("Tendencia")).alias("_s"))
             .withColumn("_s", F.col("_s") - F.avg("_s").over(_win(keys))))
    out = df.join(phase, [*keys, "_phase"], "left")
    return out.select(
        *keys, order, value,
        rnd("Tendencia", 6).alias("Tendencia"),
        rnd("_s", 6).alias("Estacionalidad"),
        rnd(F.col(value) - F.col("Tendencia") - F.col("_s"), 6).alias("Residuo"))


def unusual_days(parts: DataFrame, k: float = 2.0, order: str = "Fecha", keys=()) -> DataFrame:
    """Days whose |residual| exceeds ``k`` sample standard deviations of the residuals."""
    keys = list(keys)
    sd = F.stddev_samp("Residuo").over(_win(keys))
    flagged = parts.withColumn("_sd", sd)
    return (flagged.where(F.abs(F.col("Residuo")) > F.lit(k) * F.col("_sd"))
            .select(*keys, order, "Residuo", rnd("_sd", 6).alias("Desv_Residuo"),
                    F.when(F.col("Residuo") < 0, "CAIDA").otherwise("PICO").alias("Tipo")))
