"""Stage writers and readers, CSV export.

A stage is a versioned Parquet directory ``{root}/{name}/v={version}``.
Publishing appends a row to a small pointer table ``{root}/_pointers``
(stage, version, path, written_at); ``read_stage`` follows the newest
pointer.  Old versions are deleted only after the new one is published,
so a failed job never leaves a stage without a readable version.
Writes go through Spark's committer: a lost executor re-runs its task.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_POINTER_SCHEMA = T.StructType([
    T.StructField("stage", T.StringType()),
    T.StructField("version", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("written_at", T.TimestampType()),
])


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True)) if fs.exists(p) else False


def write_stage(df: DataFrame, root: str, name: str, partition_by=(), compression: str = "snappy",
                version: str | None = None) -> str:
    """A7 + A8 + A14: write a new version of a stage, then publish it."""
    spark = df.sparkSession
    version = version or _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d_%H%M%S_") + uuid.uuid4().hex[:6]
    path = f"{root.rstrip('/')}/{name}/v={version}"
    w = df.write.mode("overwrite").option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    ptr = spark.createDataFrame(
        [(name, version, path, _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None))], _POINTER_SCHEMA)
    ptr.coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/_pointers")
    return path


def write_bucketed(df: DataFrame, table: str, path: str, keys, buckets: int) -> DataFrame:
    """``df`` as Parquet table ``table`` at ``path``, hash-bucketed and sorted by ``keys``.

    Rows are first partitioned as the buckets are, so a task writes one file of one
    bucket (``buckets`` files in all).  A grouping or join by ``keys`` then reads the
    buckets side by side without an exchange.  ``keys`` ought to be many and even:
    a key's rows lie in one bucket.  Null keys make a bucket entry like any other.
    """
    keys = list(keys)
    df.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys) \
        .option("path", path).mode("overwrite").saveAsTable(table)
    return df.sparkSession.table(table)


def stage_versions(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Published versions of a stage, newest first."""
    ptr_path = f"{root.rstrip('/')}/_pointers"
    if not path_exists(spark, ptr_path):
        return spark.createDataFrame([], _POINTER_SCHEMA)
    return (spark.read.schema(_POINTER_SCHEMA).parquet(ptr_path)
            .where(F.col("stage") == name)
            .orderBy(F.col("written_at").desc(), F.col("version").desc()))


def read_stage(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """A5: read the newest published version of a stage (None when absent)."""
    latest = stage_versions(spark, root, name).select("path").limit(1).collect()
    if not latest:
        return None
    return spark.read.parquet(latest[0]["path"])


def retain(spark: SparkSession, root: str, name: str, keep: int = 1) -> list[str]:
    """Delete all but the ``keep`` newest published versions; returns deleted paths."""
    rows = stage_versions(spark, root, name).select("path").collect()
    dropped = [r["path"] for r in rows[keep:]]
    for p in dropped:
        delete_path(spark, p)
    return dropped


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """Typed empty frame."""
    return spark.createDataFrame([], schema)


def export_csv(df: DataFrame, path: str, single: bool = False) -> str:
    """A10 / Q2 / Q3: write the frame passed in (its columns, its order) as CSV.

    ``single=True`` funnels the output through one task; it is meant for
    small report tables.  An earlier export is always overwritten: empty input
    leaves a file with the header only.
    """
    if df.isEmpty():
        # one empty partition, so that the writer has a task to write the header
        df = df.sparkSession.createDataFrame([], df.schema).repartition(1)
    out = df.coalesce(1) if single else df
    (out.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path))
    return path


def export_all(frames: dict[str, DataFrame], root: str, single=False) -> dict[str, str]:
    """Export several frames; one failure does not stop the rest.

    ``single`` is a flag for all, or the names of the small reports to write as one file.
    """
    result: dict[str, str] = {}
    for name, df in frames.items():
        try:
            one = single if isinstance(single, bool) else name in single
            result[name] = export_csv(df, f"{root.rstrip('/')}/{name}", single=one)
        except Exception as exc:  # noqa: BLE001 - reported back, the others still run
            result[name] = f"ERROR: {type(exc).__name__}: {exc}"
    return result


def read_export(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame | None:
    """Read an exported CSV (one file or a directory of parts); absent -> None."""
    if not path_exists(spark, path):
        return None
    r = spark.read.option("header", True)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return r.csv(path)
