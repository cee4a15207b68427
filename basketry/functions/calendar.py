"""Calendar column functions (H1-H6, H15, D10 week labels).

All are native Spark expressions (no UDF), so they stay inside whole-stage
code generation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spanish day and month names used by the reports.
DAY_NAMES_ES = ("Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo")
MONTH_NAMES_ES = ("Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio", "Agosto",
                  "Septiembre", "Octubre", "Noviembre", "Diciembre")
HOURS_PER_DAY = 24


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def week_label(d) -> Column:
    """``%Y-W%U``: Sunday-first week number, days before the first Sunday are week 00."""
    d = _c(d)
    week = F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7).cast("int")
    return F.concat(F.year(d).cast("string"), F.lit("-W"), F.lpad(week.cast("string"), 2, "0"))


def month_period(d) -> Column:
    """``yyyy-MM`` month label."""
    return F.date_format(_c(d), "yyyy-MM")


def weekday_monday0(d) -> Column:
    """0 = Monday ... 6 = Sunday (pandas ``dayofweek``)."""
    return F.weekday(_c(d))


def day_name_es(d) -> Column:
    """Spanish day name from a date."""
    return F.element_at(F.array(*[F.lit(n) for n in DAY_NAMES_ES]), F.weekday(_c(d)) + 1)


def month_name_es(month) -> Column:
    """Spanish month name from a month number 1-12 (null outside)."""
    m = _c(month)
    return F.when(m.between(1, 12), F.element_at(F.array(*[F.lit(n) for n in MONTH_NAMES_ES]), m))


def simulated_hour(transaction) -> Column:
    """Q11 fallback hour: transaction id modulo 24 (non-negative)."""
    return F.pmod(_c(transaction), F.lit(HOURS_PER_DAY)).cast("int")


def sales_calendar(df: DataFrame, date: str = "Fecha", transaction: str = "ID_Transaccion",
                   timestamp: str | None = None) -> DataFrame:
    """H1/H5 columns of the sales fact.

    ``Dia_Semana`` and ``DiaSemana`` follow Spark (1 = Sunday), as the
    reference's fact does; ``DiaSemana_L0`` is 0 = Monday.  ``Hora`` is the
    real hour when a timestamp column is given, else the simulated one.
    """
    d = F.col(date)
    hour = F.hour(F.col(timestamp)) if timestamp else simulated_hour(transaction)
    return df.withColumns({
        "Anio": F.year(d),
        "Mes": F.month(d),
        "Dia": F.dayofmonth(d),
        "Dia_Semana": F.dayofweek(d),
        "Semana_Anio": F.weekofyear(d),
        "Hora": hour,
        "HoraDelDia": hour,
        "DiaSemana": F.dayofweek(d),
        "DiaSemana_L0": weekday_monday0(d),
    })


def calendar_features(df: DataFrame, date: str = "Fecha") -> DataFrame:
    """H1-H4, H6, H15 labels for a date column."""
    d = F.col(date)
    return df.withColumns({
        "Periodo_Mes": month_period(d),
        "Semana_Etiqueta": week_label(d),
        "Nombre_Dia": F.date_format(d, "EEEE"),
        "Nombre_Mes": F.date_format(d, "MMMM"),
        "Dia_ES": day_name_es(d),
        "Mes_ES": month_name_es(F.month(d)),
        "Epoch_Seg": F.unix_date(d).cast("long") * 86400,
    })
