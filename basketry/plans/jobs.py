"""Batch jobs: the entry points a user of the reference runs, re-expressed
with this library's operators.

* ``transform_job``: raw store files + catalogue files -> cleaned, enriched
  sales fact, published as a versioned stage partitioned by year and month.
* ``models_job``: sales stage -> customer segments (K-Means on recency and
  units) and basket itemsets / rules (FP-Growth, no sampling or cap unless
  asked), each published as a stage.
* ``export_job``: stages -> CSV files (the frame passed in, its columns and
  order), one failure does not stop the others.
* ``verify_job``: counts and checks per stage as a DataFrame.

Paths are arguments (nothing is hard-coded); every step is a Spark job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions import calendar as cal
from basketry.operators import basket as bk
from basketry.operators import clean as cl
from basketry.operators import customers as cu
from basketry.operators import enrich as en
from basketry.operators import profile as pf
from basketry.operators import kmeans as km
from basketry.operators import segment as sg
from basketry.sources import sinks
from basketry.sources import text as tx
from basketry.sources.tables import SALES_COLUMNS

@dataclass(frozen=True)
class ModelParams:
    k: int = 4
    elbow_ks: tuple = (2, 3, 4, 5, 6)
    seed: int = 42
    max_iter: int = 20
    min_support: float = 0.10
    min_confidence: float = 0.5
    sample_fraction: float | None = None


def transform_job(spark: SparkSession, transactions_glob: str, categories_path: str,
                  product_category_path: str, out_root: str, rules: cl.CleanRules | None = None,
                  keep: int | None = 2) -> str:
    """Raw files -> sales stage."""
    raw = tx.read_transactions(spark, transactions_glob)
    lines = cl.clean_lines(raw, rules)
    enriched = en.enrich(lines, tx.read_product_category(spark, product_category_path),
                         tx.read_categories(spark, categories_path))
    sales = cal.sales_calendar(enriched).select(*SALES_COLUMNS).hint("rebalance", "Anio", "Mes")
    path = sinks.write_stage(sales, out_root, "sales", partition_by=("Anio", "Mes"))
    if keep:
        sinks.retain(spark, out_root, "sales", keep)
    return path


def models_job(spark: SparkSession, stage_root: str, params: ModelParams = ModelParams()) -> dict[str, str]:
    """Sales stage -> clusters, elbow, itemsets, rules stages."""
    sales = sinks.read_stage(spark, stage_root, "sales")
    if sales is None:
        raise FileNotFoundError(f"no published sales stage under {stage_root}")
    out: dict[str, str] = {}

    # one row per basket, written once: scaling, the elbow and the fit all read it
    sinks.write_stage(cu.rf_features(sales).select("ID_Tienda", "ID_Transaccion", *sg.FEATURES), stage_root, "rf")
    rf = sinks.read_stage(spark, stage_root, "rf")

    def stage(df, name):
        sinks.write_stage(df, stage_root, f"kmeans-{name}")
        return sinks.read_stage(spark, stage_root, f"kmeans-{name}")

    if params.elbow_ks:
        out["elbow"] = sinks.write_stage(km.elbow(rf, params.elbow_ks, sg.FEATURES, params.seed, params.max_iter, stage),
                                         stage_root, "elbow")
    model = km.fit(rf, params.k, sg.FEATURES, params.seed, params.max_iter, stage)
    clusters = km.assign(rf, model).select("ID_Transaccion", "ID_Tienda", *sg.FEATURES, "Cluster")
    out["clusters"] = sinks.write_stage(clusters, stage_root, "clusters")

    lines = sales.select("ID_Tienda", "ID_Transaccion", F.col("ID_Producto").alias("Item"))
    b = bk.baskets(lines, "Item", min_size=2)
    if params.sample_fraction is not None:
        b = bk.sample_baskets(b, params.sample_fraction, params.seed)
    sinks.write_stage(b, stage_root, "baskets")
    b = sinks.read_stage(spark, stage_root, "baskets")
    # the stages hold every itemset and rule; a top n is a report over them
    out["itemsets"] = sinks.write_stage(bk.mine(b, params.min_support, params.min_confidence)[0], stage_root, "itemsets")
    its = sinks.read_stage(spark, stage_root, "itemsets")
    rules = bk.rules_from(its, b.agg(F.count(F.lit(1))).scalar(), params.min_confidence)
    out["rules"] = sinks.write_stage(rules, stage_root, "rules")
    return out


def export_job(spark: SparkSession, stage_root: str, export_root: str, single: bool = False) -> dict:
    """Stages -> CSV (A10, A11, Q2, Q3): sales columns, clusters, rules by lift, itemsets as text."""
    frames: dict[str, DataFrame] = {}
    sales = sinks.read_stage(spark, stage_root, "sales")
    if sales is not None:
        frames["ventas_detalladas"] = sales.select("ID_Transaccion", "ID_Tienda", "Fecha", "ID_Producto",
                                                   "Nombre_Categoria", "Anio", "Mes", "DiaSemana", "Hora")
    clusters = sinks.read_stage(spark, stage_root, "clusters")
    if clusters is not None:
        frames["clusters"] = clusters
    rules = sinks.read_stage(spark, stage_root, "rules")
    if rules is not None:
        frames["reglas"] = bk.rules_report(rules).orderBy(F.col("Lift").desc(), "Antecedente_Str",
                                                           "Consecuente_Str")
    its = sinks.read_stage(spark, stage_root, "itemsets")
    if its is not None:
        frames["itemsets"] = its.select(bk._txt("items").alias("Productos"), F.col("freq").alias("Frecuencia")) \
            .orderBy(F.col("Frecuencia").desc(), "Productos")
    return sinks.export_all(frames, export_root, single=single)


def verify_job(spark: SparkSession, stage_root: str) -> DataFrame:
    """One report over the published stages."""
    stages = {n: df for n in ("sales", "clusters", "itemsets", "rules")
              if (df := sinks.read_stage(spark, stage_root, n)) is not None}
    if "rules" in stages:
        stages["rules"] = bk.rules_report(stages["rules"])
    return pf.verify_outputs(stages)
