"""Pipe-delimited text sources (A1-A4) and the raw-format writers used to
re-create them from the driver tables.

Every reader takes an explicit schema (no inference pass over the data).
Typed CSV reads in the default permissive mode turn a stray header line
into a row of nulls, which ``clean.drop_headers`` removes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PIPE = "|"

CATEGORY_SCHEMA = T.StructType([
    T.StructField("ID_Categoria", T.IntegerType()),
    T.StructField("Nombre_Categoria", T.StringType()),
])
# Header names of the product -> category file (dotted, renamed on read).
PRODUCT_CATEGORY_HEADER = ("v.Code_pr", "v.code")
PRODUCT_CATEGORY_SCHEMA = T.StructType([
    T.StructField(PRODUCT_CATEGORY_HEADER[0], T.LongType()),
    T.StructField(PRODUCT_CATEGORY_HEADER[1], T.IntegerType()),
])
TRANSACTION_SCHEMA = T.StructType([
    T.StructField("Fecha", T.StringType()),
    T.StructField("ID_Tienda", T.IntegerType()),
    T.StructField("ID_Transaccion", T.LongType()),
    T.StructField("ID_Productos_Raw", T.StringType()),
])


def read_categories(spark: SparkSession, path: str) -> DataFrame:
    """A1: headerless ``ID|Name`` file (names may hold commas and hyphens)."""
    return spark.read.schema(CATEGORY_SCHEMA).option("sep", PIPE).option("header", False).csv(path)


def read_product_category(spark: SparkSession, path: str) -> DataFrame:
    """A2: headed ``v.Code_pr|v.code`` file, renamed to ID_Producto, ID_Categoria."""
    df = spark.read.schema(PRODUCT_CATEGORY_SCHEMA).option("sep", PIPE).option("header", True).csv(path)
    return df.withColumnsRenamed({PRODUCT_CATEGORY_HEADER[0]: "ID_Producto",
                                  PRODUCT_CATEGORY_HEADER[1]: "ID_Categoria"})


def read_transactions(spark: SparkSession, glob: str, lineage: bool = False) -> DataFrame:
    """A3: all store files matching ``glob`` as one table (one scan)."""
    df = spark.read.schema(TRANSACTION_SCHEMA).option("sep", PIPE).option("header", False).csv(glob)
    if lineage:
        df = df.withColumn("Archivo", F.col("_metadata.file_path"))
    return df


def read_store_dirs(spark: SparkSession, root: str) -> DataFrame:
    """A4: per-store directories ``root/ID_Tienda=k/`` read as one table.

    The store id comes from the directory name (partition discovery), so
    adding a store is adding a directory; no per-file loop on the driver.
    """
    schema = T.StructType([f for f in TRANSACTION_SCHEMA.fields if f.name != "ID_Tienda"]
                          + [T.StructField("ID_Tienda", T.IntegerType())])
    return (spark.read.schema(schema).option("sep", PIPE).option("header", False)
            .option("basePath", root).csv(f"{root}/ID_Tienda=*"))


# ------------------------------------------------------------------ writers
def raw_transactions(lines: DataFrame, trailing_space: bool = False) -> DataFrame:
    """Raw rows (Fecha text, store, transaction, space-separated products) from unit lines.

    Units are first counted per (transaction, product), so the array built
    per transaction is bounded by its distinct products; repeats are
    re-expanded with ``array_repeat``.  ``trailing_space`` appends a space
    (an empty token the cleaner must drop).
    """
    per = lines.groupBy("ID_Tienda", "ID_Transaccion", "Fecha", "ID_Producto").agg(F.count(F.lit(1)).alias("n"))
    raw = per.groupBy("ID_Tienda", "ID_Transaccion", "Fecha").agg(
        F.array_sort(F.collect_list(F.struct("ID_Producto", "n"))).alias("pn"))
    tokens = F.flatten(F.transform("pn", lambda s: F.array_repeat(s["ID_Producto"].cast("string"), s["n"].cast("int"))))
    text = F.concat_ws(" ", tokens)
    if trailing_space:
        text = F.concat(text, F.lit(" "))
    return raw.select(F.date_format("Fecha", "yyyy-MM-dd").alias("Fecha"), "ID_Tienda", "ID_Transaccion",
                      text.alias("ID_Productos_Raw"))


def write_pipe(df: DataFrame, path: str, header: bool = False, partition_by=(), mode: str = "overwrite") -> str:
    w = df.write.mode(mode).option("sep", PIPE).option("header", header)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)
    return path
