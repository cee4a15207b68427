"""Registered queries: name -> (Spark callable, oracle SQL or None).

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame computed
over the whole driver tables (through the materialised sales fact).  The
oracle SQL is independent ANSI SQL for DuckDB over the same tables; names
and types of the result columns match the Spark side.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ids: str = ""


_REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, ids: str = ""):
    def deco(fn):
        if name in _REGISTRY:
            raise ValueError(f"duplicate query {name}")
        _REGISTRY[name] = Query(name, fn, sql, ids)
        return fn
    return deco


def _load() -> None:
    # Importing the modules registers their queries.
    from basketry.plans import (  # noqa: F401
        basket_queries, customer_queries, profile_queries, report_queries,
        segment_queries, source_queries, stream_queries, time_queries)


def all_queries() -> dict[str, Query]:
    _load()
    return dict(_REGISTRY)


# ---------------------------------------------------------------- SQL helpers
# The sales fact in SQL, built independently from the Spark code path.
SALES_SQL = """
cats AS (
  SELECT CAST(row_number() OVER (ORDER BY p_type) AS INTEGER) AS ID_Categoria, p_type AS Nombre_Categoria
  FROM (SELECT DISTINCT p_type FROM part) t
),
pcat AS (
  SELECT p.p_partkey AS ID_Producto, c.ID_Categoria, c.Nombre_Categoria
  FROM part p JOIN cats c ON p.p_type = c.Nombre_Categoria
  WHERE p.p_size <= 45
),
sales AS (
  SELECT pcat.ID_Categoria, l.l_partkey AS ID_Producto, CAST(o.o_orderdate AS DATE) AS Fecha,
         cu.c_nationkey AS ID_Tienda, l.l_orderkey AS ID_Transaccion,
         coalesce(pcat.Nombre_Categoria, 'DESCONOCIDA') AS Nombre_Categoria,
         CAST(year(o.o_orderdate) AS INTEGER) AS Anio, CAST(month(o.o_orderdate) AS INTEGER) AS Mes,
         CAST(day(o.o_orderdate) AS INTEGER) AS Dia,
         CAST(dayofweek(o.o_orderdate) + 1 AS INTEGER) AS Dia_Semana,
         CAST(weekofyear(o.o_orderdate) AS INTEGER) AS Semana_Anio,
         CAST(l.l_orderkey % 24 AS INTEGER) AS Hora,
         CAST(l.l_orderkey % 24 AS INTEGER) AS HoraDelDia,
         CAST(dayofweek(o.o_orderdate) + 1 AS INTEGER) AS DiaSemana,
         CAST(isodow(o.o_orderdate) - 1 AS INTEGER) AS DiaSemana_L0
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer cu ON o.o_custkey = cu.c_custkey
  LEFT JOIN pcat ON l.l_partkey = pcat.ID_Producto
),
baskets AS (
  SELECT ID_Tienda, ID_Transaccion, count(*) AS Productos_Comprados, min(Fecha) AS Fecha_Compra,
         ID_Tienda AS Tienda
  FROM sales GROUP BY ID_Tienda, ID_Transaccion
)"""


def with_sales(*ctes: str, select: str) -> str:
    """``WITH <sales ctes>, <extra ctes> <select>``."""
    extra = "".join(f",\n{c}" for c in ctes)
    return f"WITH {SALES_SQL}{extra}\n{select}"
