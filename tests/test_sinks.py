"""Stages, pointer table, retention, CSV export and typed empty frames."""

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.plans.session import fresh_path, local_path
from basketry.sources import sinks


def test_stage_versions_and_retention(spark):
    root = fresh_path(spark, "stages-test")
    df = spark.range(10).withColumn("Anio", (F.col("id") % 2 + 2020).cast("int"))
    p1 = sinks.write_stage(df, root, "t", partition_by=("Anio",), version="v1")
    p2 = sinks.write_stage(df.where("id < 5"), root, "t", version="v2")
    assert sinks.read_stage(spark, root, "t").count() == 5
    assert sinks.read_stage(spark, root, "missing") is None
    assert os.path.isdir(local_path(p1) + "/Anio=2020")
    dropped = sinks.retain(spark, root, "t", keep=1)
    assert dropped == [p1] and not sinks.path_exists(spark, p1) and sinks.path_exists(spark, p2)
    assert sinks.read_stage(spark, root, "t").count() == 5


def test_export_csv_and_read_back(spark):
    root = fresh_path(spark, "export-test")
    df = spark.createDataFrame([(2, "b"), (1, "a")], "k int, v string").orderBy("k")
    p = sinks.export_csv(df.select("v", "k"), f"{root}/one", single=True)
    back = sinks.read_export(spark, p, "v string, k int")
    assert [tuple(r) for r in back.collect()] == [("a", 1), ("b", 2)]
    assert len([f for f in os.listdir(local_path(p)) if f.endswith(".csv")]) == 1
    # an empty frame replaces an earlier export by a file with the header only
    again = sinks.export_csv(df.where("k > 5").select("v", "k"), f"{root}/one")
    assert again == p and sinks.read_export(spark, p, "v string, k int").count() == 0
    assert sinks.read_export(spark, p).columns == ["v", "k"]
    assert sinks.read_export(spark, f"{root}/nothing-here") is None


def test_export_all_isolates_failures(spark):
    root = fresh_path(spark, "export-all")
    good = spark.range(3)
    bad = spark.range(3).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("id2"))
    bad = bad.withColumn("x", F.raise_error(F.lit("boom")))
    res = sinks.export_all({"good": good, "bad": bad}, root)
    assert res["good"] is not None and not res["good"].startswith("ERROR")
    assert res["bad"].startswith("ERROR")


def test_typed_empty_frame(spark):
    schema = T.StructType([T.StructField("items", T.ArrayType(T.StringType())), T.StructField("freq", T.LongType())])
    e = sinks.empty_frame(spark, schema)
    assert e.count() == 0 and e.schema == schema
