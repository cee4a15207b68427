"""Exact quantiles by distributed selection.

``F.percentile`` keeps every distinct value of a group in one task.  Here the values are
counted, range-partitioned by (group, value) and placed; one count per group and partition
then tells in which partition a rank falls, and only that partition's rows are looked into.
No task sees more than its range of distinct values, however wide the column is.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def join_null_safe(a: DataFrame, b: DataFrame, keys, how: str, also=None) -> DataFrame:
    """Join on ``keys`` with nulls equal to each other; the key columns are those of ``a``."""
    names = {k: f"_k{i}" for i, k in enumerate(keys)}
    on = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(r)) for k, r in names.items()], F.lit(True) if also is None else also)
    return a.join(b.withColumnsRenamed(names), on, how).drop(*names.values())


def exact_quantiles(df: DataFrame, value: str, probs, keys=()) -> DataFrame:
    """Per group (``keys``) the quantiles ``q0``, ``q1``, ... of ``probs``, with linear interpolation.

    Nulls are left out; a group without values has no row.  The placed counts are written to the
    checkpoint folder, so that both passes see the same partitions.
    """
    spark, keys, probs = df.sparkSession, list(keys), list(probs)
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    counts = df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull()) \
        .groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"))
    placed = counts.repartitionByRange(n, *keys, "_v").withColumn("_p", F.spark_partition_id()).checkpoint()
    group = Window.partitionBy(*keys)
    # one row per group and partition that holds some of it
    part = placed.groupBy(*keys, "_p").agg(F.sum("_c").alias("_s")) \
        .withColumns({"_before": F.coalesce(F.sum("_s").over(group.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
                      "_n": F.sum("_s").over(group)})
    ranks = F.array(*[F.struct(F.lit(i).alias("i"), (F.lit(float(p)) * (F.col("_n") - 1)).alias("at")) for i, p in enumerate(probs)])
    lower, upper = F.floor("_t.at"), F.ceil("_t.at")
    hits = part.withColumn("_t", F.explode(ranks)).withColumn("_r", F.explode(F.array(
        F.struct(F.lit(False).alias("up"), lower.alias("k")), F.struct(F.lit(True).alias("up"), upper.alias("k"))))) \
        .where((F.col("_r.k") >= F.col("_before")) & (F.col("_r.k") < F.col("_before") + F.col("_s"))) \
        .select(*keys, F.col("_p"), F.col("_t.i").alias("_i"), F.col("_r.up").alias("_up"),
                (F.col("_r.k") - F.col("_before")).alias("_k"), (F.col("_t.at") - lower).alias("_f")).checkpoint()
    spot = hits.select(*keys, "_p").distinct()
    by = [*keys, "_p"]
    inside = join_null_safe(placed, spot, by, "left_semi") \
        .withColumn("_upto", F.sum("_c").over(Window.partitionBy(*by).orderBy("_v")))
    found = join_null_safe(inside, hits, by, "inner", (F.col("_k") < F.col("_upto")) & (F.col("_k") >= F.col("_upto") - F.col("_c"))) \
        .select(*keys, "_i", "_up", "_f", "_v")

    def quantile(i):
        mine = F.col("_i") == i
        lo, hi = (F.max(F.when(mine & (F.col("_up") == up), F.col("_v"))) for up in (False, True))
        f = F.max(F.when(mine, F.col("_f")))
        return F.when(f == 0, lo).otherwise((F.lit(1.0) - f) * lo + f * hi).alias(f"q{i}")

    return found.groupBy(*keys).agg(*[quantile(i) for i in range(len(probs))])
