"""The materialised sales fact that registered queries read.

The fact joins three large tables; every query re-running those joins
would shuffle the widest table again and again.  As the reference's own
pipeline does (transform once, query the Parquet stage many times), the
fact is written once per session and driver folder to the shared scratch
folder, partitioned by year and month so date slices prune partitions.
The write goes through a ``rebalance`` hint on (year, month): every task
writes one month directory, and adaptive execution splits a month (or a
single hot date) that is too large for one task and merges small ones,
so files stay near the advisory size whatever the skew.
"""

from __future__ import annotations

import re
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.plans.session import fresh_path
from basketry.sources import sinks
from basketry.sources import tables as tb

_LOCK = threading.RLock()
_STAGES: dict[tuple[str, str], str] = {}
_FRAMES: dict[tuple[str, str, int], tuple[str, DataFrame]] = {}


def _key(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    return spark.sparkContext.applicationId, sf_dir.rstrip("/")


def build_sales(spark: SparkSession, sf_dir: str) -> str:
    """Write the sales fact stage and return its path."""
    path = fresh_path(spark, "sales")
    lines = tb.enriched_lines(spark, sf_dir)
    # the narrow lines are shuffled, by the month of the calendar; its columns come behind the shuffle
    month = {"_anio": F.year("Fecha"), "_mes": F.month("Fecha")}
    df = tb.sales_view(spark, sf_dir, lines.withColumns(month).hint("rebalance", *month).drop(*month))
    # the session keeps the path itself, so no pointer-table entry is published
    df.write.mode("overwrite").option("compression", "snappy").partitionBy("Anio", "Mes").parquet(path)
    return path


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales fact for ``sf_dir``: written on first use, then read back.

    The DataFrame over the stage is kept with its path, so the partition
    directories are listed once per session, not once per query.
    """
    key = _key(spark, sf_dir)
    with _LOCK:
        path = _STAGES.get(key)
        if path is None or not sinks.path_exists(spark, path):
            path = build_sales(spark, sf_dir)
            _STAGES[key] = path
        # the stage is shared by the application; the DataFrame belongs to one session
        fkey = (*key, id(spark))
        hit = _FRAMES.get(fkey)
        if hit is None or hit[0] != path:
            hit = (path, spark.read.parquet(path).select(*tb.SALES_COLUMNS))
            _FRAMES[fkey] = hit
    return hit[1]


def forget(spark: SparkSession | None = None) -> None:
    """Drop memoised stage paths (tests)."""
    with _LOCK:
        if spark is None:
            _STAGES.clear()
            _FRAMES.clear()
            _DERIVED.clear()
            _BUCKETED.clear()
        else:
            app = spark.sparkContext.applicationId
            for d in (_STAGES, _FRAMES, _DERIVED, _BUCKETED):
                for k in [k for k in d if k[0] == app]:
                    del d[k]


def staged(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A frame derived from the tables of ``sf_dir``, written on first use and read back."""
    key = (*_key(spark, sf_dir), name)
    with _LOCK:
        path = _DERIVED.get(key)
        if path is None or not sinks.path_exists(spark, path):
            path = fresh_path(spark, name)
            build().write.parquet(path)
            _DERIVED[key] = path
    return spark.read.parquet(path)


_DERIVED: dict[tuple[str, str, str], str] = {}


def basket_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (store, transaction): units and date (staged)."""
    from basketry.operators import customers as cu
    return staged(spark, sf_dir, "baskets", lambda: cu.basket_table(sales(spark, sf_dir)))


def sketch_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units and distinct-count sketches by day and store (staged): any slice is a union of its rows."""
    from basketry.operators import sketches as sk
    return staged(spark, sf_dir, "sketches", lambda: sk.daily_sketches(sales(spark, sf_dir)))


BUCKETED_COLUMNS = ("ID_Tienda", "ID_Transaccion", "ID_Producto", "Fecha")
_BUCKETED: dict[tuple[str, str, str], tuple[str, str]] = {}


def _bucketed(spark: SparkSession, sf_dir: str, name: str, build, keys, buckets: int | None = None) -> DataFrame:
    """A frame derived from the tables of ``sf_dir``, written bucketed and sorted by ``keys`` on first use.
    The files lie in the shared folder; the table's entry belongs to the session's catalogue."""
    key = (*_key(spark, sf_dir), name)
    with _LOCK:
        table, path = _BUCKETED.get(key, ("", ""))
        if not table or not sinks.path_exists(spark, path):
            path = fresh_path(spark, name)
            table = "basketry_" + re.sub(r"\W", "_", path.rsplit("/", 1)[1])
            sinks.write_bucketed(build(), table, path, keys, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
            _BUCKETED[key] = (table, path)
    return spark.table(table)


def sales_by_basket(spark: SparkSession, sf_dir: str, buckets: int | None = None) -> DataFrame:
    """The fact bucketed and sorted by (store, transaction), written on first use.

    Grouping by basket (baskets, recency and units) needs no shuffle of it: all
    units of a basket lie in one bucket.  ``buckets`` is the number of tasks of
    such a stage (``spark.sql.shuffle.partitions`` unless given).
    """
    def lines():
        # where no fact is there yet, its lines come straight from the joins: the wide stage is not written for them
        fact = _STAGES.get(_key(spark, sf_dir))
        return (sales(spark, sf_dir) if fact and sinks.path_exists(spark, fact) else tb.enriched_lines(spark, sf_dir)) \
            .select(*BUCKETED_COLUMNS)

    return _bucketed(spark, sf_dir, "sales-by-basket", lines, ("ID_Tienda", "ID_Transaccion"), buckets)


def rf_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recency and units per basket (staged): scaling, fits and profiles all read it."""
    from basketry.operators import customers as cu
    from basketry.operators import segment as sg
    return staged(spark, sf_dir, "rf", lambda: cu.rf_features(sales_by_basket(spark, sf_dir)).select(
        "ID_Tienda", "ID_Transaccion", *sg.FEATURES))


# ------------------------------------------------------------------ mining
# Fixed parameters of the registered mining queries (driver data: association is weak by
# construction, so thresholds are low).  Items are part brands, or part types where itemsets of
# three and more items are wanted.
MINING_ITEM, MINING_TYPE = "p_brand", "p_type"
MINING_MIN_SUPPORT = 0.01
MINING_MIN_CONFIDENCE = 0.05
STORE_MIN_COUNT = 3  # baskets an itemset needs in every store, beside the support


def item_lines(spark: SparkSession, sf_dir: str, item: str = MINING_ITEM) -> DataFrame:
    """Basket key + item per unit line (item = an attribute of the part), off the bucketed fact:
    while the parts pass Spark's size check for a broadcast, baskets need no shuffle."""
    part = tb.read_table(spark, sf_dir, "part").select(F.col("p_partkey").alias("ID_Producto"),
                                                       F.col(item).alias("Item"))
    return sales_by_basket(spark, sf_dir).select("ID_Tienda", "ID_Transaccion", "ID_Producto").join(part, "ID_Producto") \
        .select("ID_Tienda", "ID_Transaccion", "Item")


def mining_baskets(spark: SparkSession, sf_dir: str, item: str = MINING_ITEM) -> DataFrame:
    """Baskets of at least two distinct items (mining, pairs and recommendations read it), bucketed by basket:
    what is looked up for their items is gathered again without a shuffle."""
    from basketry.operators import basket as bk

    def build():
        # where the lines by basket are not there yet, they are not written for these; a basket is a set, so lines
        # that a repeated product doubles there do not matter
        _, path = _BUCKETED.get((*_key(spark, sf_dir), "sales-by-basket"), ("", ""))
        lines = item_lines if path and sinks.path_exists(spark, path) else tb.order_items
        return bk.baskets(lines(spark, sf_dir, item), "Item", min_size=2)

    return _bucketed(spark, sf_dir, f"mining-baskets-{item}", build, ("ID_Tienda", "ID_Transaccion"))


def n_mining_baskets(spark: SparkSession, sf_dir: str, item: str = MINING_ITEM):
    """Number of mining baskets, as a scalar subquery column."""
    return mining_baskets(spark, sf_dir, item).agg(F.count(F.lit(1))).scalar()


def mined(spark: SparkSession, sf_dir: str, item: str = MINING_ITEM) -> tuple[DataFrame, DataFrame]:
    """Itemsets of all lengths and rules for ``sf_dir``: FP-Growth runs once, the
    itemsets are staged, and the rules are read off the staged itemsets."""
    from basketry.operators import basket as bk
    paths: list[str] = []

    def stage(df):
        paths.append(fresh_path(spark, f"transactions-{item}"))
        df.write.parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    its = staged(spark, sf_dir, f"itemsets-{item}", lambda: bk.mine(
        mining_baskets(spark, sf_dir, item), MINING_MIN_SUPPORT, MINING_MIN_CONFIDENCE, stage=stage)[0])
    for path in paths:  # the itemsets are written: nothing reads them any more
        sinks.delete_path(spark, path)
    rules = staged(spark, sf_dir, f"rules-{item}", lambda: bk.rules_from(
        its, n_mining_baskets(spark, sf_dir, item), MINING_MIN_CONFIDENCE))
    return its, rules


def mined_by(spark: SparkSession, sf_dir: str, key: str = "ID_Tienda") -> tuple[DataFrame, DataFrame]:
    """Per-key itemsets and rules, each key at its own threshold (staged)."""
    from basketry.operators import basket as bk
    out: list[DataFrame] = []

    def both():
        if not out:
            def stage(df, name):
                path = fresh_path(spark, f"by-{key}-{name}")
                df.write.parquet(path)
                return spark.read.schema(df.schema).parquet(path)
            out.extend(bk.mine_by_key(mining_baskets(spark, sf_dir), key, MINING_MIN_SUPPORT, MINING_MIN_CONFIDENCE,
                                      STORE_MIN_COUNT, stage))
        return out

    return (staged(spark, sf_dir, f"itemsets-by-{key}", lambda: both()[0]),
            staged(spark, sf_dir, f"rules-by-{key}", lambda: both()[1]))
