"""Shared helpers of the training-data operators.

``stage`` is the only lineage cut used here: a Parquet table in the folder
named by ``spark.checkpoint.dir`` (shared by driver and executors), so a
lost executor costs a re-read, never a rebuild of the plan above it.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.plans.session import fresh_path
from basketry.sources.sinks import delete_path

# A word is a run of characters other than ASCII white space.
WORD_RE = r"[^\x20\x09-\x0D]+"


_SHIPPED: set[str] = set()


def ship(df: DataFrame) -> DataFrame:
    """Send this package's source to the Python workers (once an application), as
    ``--py-files`` would, so that functions which run there can be imported."""
    sc = df.sparkSession.sparkContext
    if sc.applicationId not in _SHIPPED:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="basketry-src-")), "basketry_src.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, names in os.walk(root):
                for n in names:
                    if n.endswith(".py"):
                        z.write(os.path.join(folder, n), os.path.relpath(os.path.join(folder, n), os.path.dirname(root)))
        sc.addPyFile(path)  # the driver serves it to the executors
        _SHIPPED.add(sc.applicationId)
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver tables, through Spark's reader."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_RECORDERS: list[list[str]] = []


def stage(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a frame that reads it back."""
    path = fresh_path(df.sparkSession, f"llm-{tag}")
    for r in _RECORDERS:
        r.append(path)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def recording():
    """Collect the paths of the tables that ``stage`` writes meanwhile."""
    paths: list[str] = []
    _RECORDERS.append(paths)
    try:
        yield paths
    finally:
        _RECORDERS[:] = [r for r in _RECORDERS if r is not paths]


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete staged tables that nothing reads any more."""
    for p in paths:
        delete_path(spark, p)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (Spark compares without case)."""
    taken, name = {c.lower() for c in df.columns}, base
    while name.lower() in taken:
        name += "_"
    return name


def quoted(name: str) -> Column:
    """Column by its literal name (dots and spaces included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def with_uid(df: DataFrame, name: str) -> DataFrame:
    """Number rows uniquely (not gaplessly).  Ids hold once the frame is staged."""
    return df.withColumn(name, F.monotonically_increasing_id())


def bucket_crc(id_col: Column, mod: int) -> Column:
    """crc32 of the id written as text, modulo ``mod`` (the fold rule of the learned operators)."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(mod))


def global_rank(df: DataFrame, order: list[str], name: str, tag: str) -> DataFrame:
    """Append ``name``: the gapless 0-based position of each row in the order of
    the columns ``order`` (nulls first), without bringing the rows to one task.

    Rows are range-partitioned (fully equal rows are told apart by an arrival
    number, so a hot key splits over partitions), sorted inside each partition
    and staged with their place in it; the only rows that meet in one place are
    one count per partition.
    """
    spark = df.sparkSession
    tie, place, part = "__tie", "__place", "__part"
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cols = [quoted(c) for c in order]
    placed = stage(
        df.withColumn(tie, F.monotonically_increasing_id())
        .repartitionByRange(n, *cols, F.col(tie)).sortWithinPartitions(*cols, F.col(tie)).drop(tie)
        .withColumn(place, F.monotonically_increasing_id()), tag)
    placed = placed.select("*", F.shiftright(place, 33).alias(part)) \
        .withColumn(place, F.col(place).bitwiseAND(F.lit((1 << 33) - 1)))
    counts = placed.groupBy(part).agg(F.count(F.lit(1)).alias("__n"))
    before = counts.select(part, F.coalesce(
        F.sum("__n").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    # one row per range partition: bounded by the partition count above
    return placed.join(F.broadcast(before), part) \
        .withColumn(name, F.col("__before") + F.col(place)).drop(part, place, "__before")


def components(edges: DataFrame, tag: str) -> DataFrame:
    """Connected components of ``edges`` (u, v): columns (node, root), root = smallest
    node reachable, for every node that has an edge.

    Alternating large-star / small-star: each round is two keyed aggregations,
    staged in the shared folder; it ends when a round changes no edge.  A node of
    many links only meets its smallest neighbour, never all pairs of them.
    """
    spark = edges.sparkSession
    cur = stage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                .filter("u <> v").distinct(), f"{tag}-edges")

    def fingerprint(df):
        r = df.agg(F.count(F.lit(1)).alias("n"),
                   F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        return r["n"], r["h"]

    def hooked(pairs, keep):
        # pairs (u, v): every neighbour v of u that passes ``keep`` hangs on u's smallest neighbour or u itself
        low = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return pairs.join(low, "u").filter(keep).select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .filter("u <> v")

    seen = fingerprint(cur)
    while seen[0]:
        both = cur.select("u", "v").unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = hooked(both, F.col("v") > F.col("u"))  # larger neighbours hang on the minimum
        large = stage(large.unionByName(
            both.groupBy("u").agg(F.min("v").alias("v")).filter("v < u")).distinct(), f"{tag}-large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))  # small-star: all neighbours here are smaller
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v") \
            .unionByName(low.select("u", F.col("m").alias("v")))
        cur = stage(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .distinct(), f"{tag}-small")
        now = fingerprint(cur)
        if now == seen:
            break
        seen = now
    tree = cur.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return tree.unionByName(tree.select(F.col("root").alias("node"), "root").distinct())
