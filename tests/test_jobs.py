"""End to end: raw pipe files -> transform -> models -> export -> verify."""

import os

from pyspark.sql import functions as F

from basketry.plans.facts import sales
from basketry.plans.jobs import ModelParams, export_job, models_job, transform_job, verify_job
from basketry.plans.session import fresh_path, local_path
from basketry.sources import sinks
from basketry.sources import tables as tb
from basketry.sources import text as tx


def test_batch_jobs_end_to_end(spark, sf):
    root = fresh_path(spark, "jobs")
    lines = sales(spark, sf).select("Fecha", "ID_Tienda", "ID_Transaccion", "ID_Producto")
    tx.write_pipe(tx.raw_transactions(lines, trailing_space=True), f"{root}/raw/Transactions", header=True)
    cats = tb.categories(spark, sf)
    tx.write_pipe(cats, f"{root}/raw/Categories")
    pc = tb.product_category(spark, sf, cats).select(F.col("ID_Producto").alias("v.Code_pr"),
                                                      F.col("ID_Categoria").alias("v.code"))
    tx.write_pipe(pc, f"{root}/raw/ProductCategory", header=True)

    stage_root = f"{root}/stages"
    transform_job(spark, f"{root}/raw/Transactions/*.csv", f"{root}/raw/Categories",
                  f"{root}/raw/ProductCategory", stage_root)
    fact = sinks.read_stage(spark, stage_root, "sales")
    expected = sales(spark, sf)
    assert sorted(map(tuple, fact.select(*tb.SALES_COLUMNS).collect()), key=repr) == \
        sorted(map(tuple, expected.collect()), key=repr)

    out = models_job(spark, stage_root, ModelParams(elbow_ks=(2, 3), min_support=0.01, min_confidence=0.1))
    assert set(out) == {"elbow", "clusters", "itemsets", "rules"}
    clusters = sinks.read_stage(spark, stage_root, "clusters")
    assert clusters.count() == expected.select("ID_Tienda", "ID_Transaccion").distinct().count()

    exported = export_job(spark, stage_root, f"{root}/export")
    # product ids are sparse at this scale: itemsets / rules may be empty (exported as a header)
    assert not [v for v in exported.values() if v and v.startswith("ERROR")], exported
    assert exported["ventas_detalladas"] and exported["clusters"]
    assert os.path.isdir(local_path(exported["ventas_detalladas"]))

    report = {(r.Etapa, r.Chequeo): r for r in verify_job(spark, stage_root).collect()}
    assert report[("sales", "filas")].Valor == expected.count()
    assert report[("sales", "filas")].OK and report[("clusters", "filas")].OK
