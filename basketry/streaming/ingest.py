"""Incremental ingestion with Structured Streaming.

The reference waits for files and re-runs the batch job.  Here newly
arrived raw files are processed once each, with the same DataFrame
functions as the batch path:

* ``ingest``: file stream -> clean -> stream-static joins with the
  catalogue -> calendar columns -> Parquet sink.  The checkpoint records
  which files were processed, so re-runs and lost executors neither skip
  nor double-count files.  ``trigger(availableNow=True)`` processes what is
  there and stops (the scheduled-job form of a stream).
* ``merge_daily``: units per (date, store, transaction) of each batch, under
  ``open/batch_id=N`` with overwrite, so a replayed batch replaces its own output.
  Distinct baskets are not additive when a basket is split over batches, hence a
  base beside the open batches: figures per day up to a high-water batch id, and the keys
  of the baskets counted there, by month.  A read takes the base's few rows, the open batches and the keys
  of their months.  ``compact_daily`` moves committed batches into the base; the pointer
  table publishes it with its high-water id, and only then are those batches deleted.
* ``merge_pairs``: pair counts by difference.  A stateful aggregation (RocksDB state)
  holds each basket's items with the batch that brought them; a batch emits the baskets it
  touches and no others, and adds one to each of their pairs that has a new item.  The
  counts of a batch lie under its id; reads add them up, ``compact_pairs`` does so for good.
* ``dedup_to``: Spark's own streaming ``dropDuplicates`` over RocksDB state, keyed by the whole
  content of a raw row.  No watermark: a first delivery is kept however late it comes, a
  repeat is dropped however late it comes, and since repeats are equal it does not matter which one stays.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions import calendar as cal
from basketry.operators import clean as cl
from basketry.operators import enrich as en
from basketry.sources import sinks
from basketry.sources import text as tx
from basketry.sources.tables import SALES_COLUMNS



def raw_stream(spark: SparkSession, raw_dir: str, max_files: int | None = None) -> DataFrame:
    r = (spark.readStream.schema(tx.TRANSACTION_SCHEMA).option("sep", tx.PIPE).option("header", False))
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.csv(raw_dir)


def _run(writer, available_now: bool = True):
    q = writer.trigger(availableNow=True).start() if available_now else writer.start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


@contextmanager
def _rocksdb(spark: SparkSession):
    """Queries that start inside keep their state in RocksDB: on disk, with only changes uploaded to the checkpoint,
    and without a second lookup of each key to count the rows."""
    store = "spark.sql.streaming.stateStore"
    ours = {f"{store}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
            f"{store}.rocksdb.changelogCheckpointing.enabled": "true", f"{store}.rocksdb.trackTotalNumberOfRows": "false"}
    before = {key: spark.conf.get(key, None) for key in ours}
    for key, value in ours.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def ingest(spark: SparkSession, raw_dir: str, out_dir: str, checkpoint: str, product_category: DataFrame,
           categories: DataFrame, default: str = "DESCONOCIDA") -> str:
    """Process newly arrived raw files into the sales Parquet sink."""
    lines = cl.clean_lines(raw_stream(spark, raw_dir))
    sales = cal.sales_calendar(en.enrich(lines, product_category, categories, default=default))
    w = (sales.select(*SALES_COLUMNS).writeStream.format("parquet").outputMode("append")
         .partitionBy("Anio", "Mes").option("checkpointLocation", checkpoint).option("path", out_dir))
    _run(w)
    return out_dir


# ------------------------------------------------------------- batches and bases
def open_batches(spark: SparkSession, state_dir: str) -> dict[int, str]:
    """Batch id -> path of the batch outputs that are there."""
    fs, p = sinks._fs(spark, f"{state_dir}/open/batch_id=*")
    return {int(f.getPath().getName().split("=")[1]): f.getPath().toString() for f in fs.globStatus(p) or []}


def published(spark: SparkSession, state_dir: str, name: str) -> tuple[int, DataFrame | None]:
    """High-water batch id and table of the newest published base (-1 and None before the first)."""
    top = sinks.stage_versions(spark, state_dir, name).orderBy(F.col("version").desc()).limit(1).collect()
    return (int(top[0]["version"].split("-")[1]), spark.read.parquet(top[0]["path"])) if top else (-1, None)


def _publish(spark: SparkSession, df: DataFrame, state_dir: str, name: str, upto: int) -> None:
    """Write a base and its pointer, then drop what it replaces (older bases, its batches)."""
    sinks.write_stage(df, state_dir, name, version=f"hwm-{upto:012d}")
    _sweep(spark, state_dir, name, upto)


def _sweep(spark: SparkSession, state_dir: str, name: str, upto: int) -> None:
    for n, path in open_batches(spark, state_dir).items():
        if n <= upto:
            sinks.delete_path(spark, path)
    for r in sinks.stage_versions(spark, state_dir, name).collect():  # one row per compaction
        if int(r["version"].split("-")[1]) < upto:
            sinks.delete_path(spark, r["path"])


def _pending(spark: SparkSession, state_dir: str, hwm: int, upto: int | None = None) -> list[str]:
    return [p for n, p in sorted(open_batches(spark, state_dir).items()) if n > hwm and (upto is None or n <= upto)]


# ------------------------------------------------------------- daily figures
_BASKET = ["Fecha", "ID_Tienda", "ID_Transaccion"]
_DAILY_SCHEMA = "Fecha date, Total_Productos_Vendidos long, Numero_Transacciones long"
KEY_RUNS = 8  # key tables that stand beside each other before they are merged into one


def merge_daily(spark: SparkSession, raw_dir: str, state_dir: str, checkpoint: str, compact_every: int = 10,
                max_files: int | None = None):
    """Units per (date, store, transaction) of each batch; every ``compact_every`` batches the committed
    ones go into the base.  Returns the finished query."""
    def per_batch(df: DataFrame, batch_id: int) -> None:
        if batch_id and batch_id % compact_every == 0:
            compact_daily(spark, state_dir, batch_id - 1)  # earlier batches are committed, this one is not
        cl.clean_lines(df).groupBy(*_BASKET).agg(F.count(F.lit(1)).alias("Unidades")) \
            .write.mode("overwrite").parquet(f"{state_dir}/open/batch_id={batch_id}")

    return _run(raw_stream(spark, raw_dir, max_files).writeStream.foreachBatch(per_batch)
                .option("checkpointLocation", checkpoint))


def _key_runs(spark: SparkSession, state_dir: str, hwm: int) -> dict[tuple[int, int], str]:
    """(first, last batch) -> path of the key tables that make up the base: from the high-water id back to 0."""
    fs, p = sinks._fs(spark, f"{state_dir}/keys/run=*")
    found: dict[int, tuple[int, str]] = {}
    for f in fs.globStatus(p) or []:
        lo, hi = (int(x) for x in f.getPath().getName().split("=")[1].split("_"))
        if hi not in found or lo < found[hi][0]:
            found[hi] = (lo, f.getPath().toString())
    out, hi = {}, hwm
    while hi >= 0:
        lo, path = found[hi]
        out[lo, hi] = path
        hi = lo - 1
    return out


def _with_month(df: DataFrame) -> DataFrame:
    return df.withColumn("Mes_Cesta", F.coalesce(F.date_format("Fecha", "yyyy-MM"), F.lit("nulo")))


def _new_baskets(spark: SparkSession, parts: DataFrame, runs) -> DataFrame:
    """Rows of ``parts`` whose basket is in none of the key tables; only the months of ``parts`` are read."""
    parts = _with_month(parts)
    if not runs:
        return parts
    months = [r[0] for r in parts.select("Mes_Cesta").distinct().collect()]  # calendar months
    keys = None
    for path in runs.values():
        one = spark.read.parquet(path).where(F.col("Mes_Cesta").isin(months))
        keys = one if keys is None else keys.unionByName(one)
    same = [parts[c].eqNullSafe(keys[c]) for c in _BASKET]
    return parts.join(keys, [parts["Mes_Cesta"] == keys["Mes_Cesta"], *same], "left_anti")


def _daily_delta(parts: DataFrame, new: DataFrame) -> DataFrame:
    units = parts.groupBy("Fecha").agg(F.sum("Unidades").alias("u")).withColumn("t", F.lit(0).cast("long"))
    first = new.groupBy("Fecha").agg(F.count(F.lit(1)).alias("t")).withColumn("u", F.lit(0).cast("long"))
    return units.unionByName(first).select("Fecha", F.col("u").alias("Total_Productos_Vendidos"),
                                           F.col("t").alias("Numero_Transacciones"))


def _added(df: DataFrame, base: DataFrame | None) -> DataFrame:
    df = df if base is None else base.unionByName(df)
    return df.groupBy("Fecha").agg(F.sum("Total_Productos_Vendidos").alias("Total_Productos_Vendidos"),
                                   F.sum("Numero_Transacciones").alias("Numero_Transacciones"))


def _baskets_of(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.parquet(*paths).groupBy(*_BASKET).agg(F.sum("Unidades").alias("Unidades"))


def compact_daily(spark: SparkSession, state_dir: str, upto: int) -> None:
    """Move the batches up to ``upto`` into the base.

    The keys of their new baskets are written first, then the figures per day, then the pointer with ``upto``.
    Until the pointer is there, readers take the old base and the batches; a key table beyond the
    published id is a leftover of a crash and is removed.
    """
    hwm, base = published(spark, state_dir, "daily")
    _sweep(spark, state_dir, "daily", hwm)  # what a crash behind the pointer has left
    paths = _pending(spark, state_dir, hwm, upto)
    if not paths:
        return
    fs, p = sinks._fs(spark, f"{state_dir}/keys/run=*")
    for f in fs.globStatus(p) or []:
        if int(f.getPath().getName().split("_")[1]) > hwm:
            sinks.delete_path(spark, f.getPath().toString())
    runs = _key_runs(spark, state_dir, hwm)
    parts = _baskets_of(spark, paths)
    run = f"{state_dir}/keys/run={hwm + 1}_{upto}"
    _new_baskets(spark, parts, runs).select("Mes_Cesta", *_BASKET).write.mode("overwrite").partitionBy("Mes_Cesta").parquet(run)
    merged = len(runs) + 1 > KEY_RUNS
    new = spark.read.schema("ID_Tienda int, ID_Transaccion long, Fecha date, Mes_Cesta string").parquet(run)
    if merged:
        both = new
        for path in runs.values():
            both = both.unionByName(spark.read.schema(new.schema).parquet(path))
        both.hint("rebalance", "Mes_Cesta").write.mode("overwrite").partitionBy("Mes_Cesta").parquet(f"{state_dir}/keys/run=0_{upto}")
    _publish(spark, _added(_daily_delta(parts, new), base), state_dir, "daily", upto)
    if merged:
        for path in [*runs.values(), run]:
            if not path.endswith(f"run=0_{upto}"):
                sinks.delete_path(spark, path)


def read_daily(spark: SparkSession, state_dir: str) -> DataFrame:
    """Figures per day: the base, and the open batches with the baskets that are new in them."""
    hwm, base = published(spark, state_dir, "daily")
    paths = _pending(spark, state_dir, hwm)
    if not paths:
        return base if base is not None else spark.createDataFrame([], _DAILY_SCHEMA)
    parts = _baskets_of(spark, paths)
    return _added(_daily_delta(parts, _new_baskets(spark, parts, _key_runs(spark, state_dir, hwm))), base)


# ------------------------------------------------------------- pair counts
def basket_items(spark: SparkSession, raw_dir: str, items: DataFrame, max_files: int | None = None) -> DataFrame:
    """Streaming frame: per basket its items, each with the (time of the) batches that brought it."""
    lines = cl.clean_lines(raw_stream(spark, raw_dir, max_files)).join(items, "ID_Producto")
    return lines.withColumn("Lote", F.current_timestamp()).groupBy("ID_Tienda", "ID_Transaccion") \
        .agg(F.collect_set(F.struct("Item", "Lote")).alias("Entradas"))


def new_pairs(touched: DataFrame) -> DataFrame:
    """Pairs of each touched basket with at least one item that its last batch brought first, counted."""
    last = F.array_max(F.transform("Entradas", lambda e: e["Lote"]))
    names = lambda entries: F.array_distinct(F.transform(entries, lambda e: e["Item"]))
    old = touched.withColumn("_last", last).withColumn(
        "_old", names(F.filter("Entradas", lambda e: e["Lote"] < F.col("_last")))).withColumn("_all", names(F.col("Entradas")))
    split = old.select("_old", F.array_sort(F.array_except("_all", "_old")).alias("_new"))
    heads = split.select("_old", "_new", F.posexplode("_new").alias("_p", "_a"))
    pairs = heads.select("_a", F.explode(F.concat("_old", F.slice("_new", F.col("_p") + 2, F.size("_new")))).alias("_b"))
    return pairs.groupBy(F.least("_a", "_b").alias("Item_A"), F.greatest("_a", "_b").alias("Item_B")) \
        .agg(F.count(F.lit(1)).alias("Transacciones"))


def merge_pairs(spark: SparkSession, raw_dir: str, state_dir: str, checkpoint: str, items: DataFrame,
                compact_every: int = 10, max_files: int | None = None):
    """Pairs that each batch adds (``items``: ID_Producto -> Item).  Returns the finished query."""
    def per_batch(df: DataFrame, batch_id: int) -> None:
        if batch_id and batch_id % compact_every == 0:
            compact_pairs(spark, state_dir, batch_id - 1)
        new_pairs(df).write.mode("overwrite").parquet(f"{state_dir}/open/batch_id={batch_id}")

    with _rocksdb(spark):
        return _run(basket_items(spark, raw_dir, items, max_files).writeStream.outputMode("update")
                    .foreachBatch(per_batch).option("checkpointLocation", checkpoint))


def _pair_sums(spark: SparkSession, base: DataFrame | None, paths: list[str]) -> DataFrame:
    rows = base
    if paths:
        added = spark.read.parquet(*paths)
        rows = added if rows is None else rows.unionByName(added)
    return rows.groupBy("Item_A", "Item_B").agg(F.sum("Transacciones").alias("Transacciones"))


def compact_pairs(spark: SparkSession, state_dir: str, upto: int) -> None:
    """Add the batches up to ``upto`` to the base."""
    hwm, base = published(spark, state_dir, "pairs")
    _sweep(spark, state_dir, "pairs", hwm)
    paths = _pending(spark, state_dir, hwm, upto)
    if paths:
        _publish(spark, _pair_sums(spark, base, paths), state_dir, "pairs", upto)


def read_pairs(spark: SparkSession, state_dir: str, min_count: int = 2) -> DataFrame:
    """Pair counts: the base plus the open batches."""
    hwm, base = published(spark, state_dir, "pairs")
    paths = _pending(spark, state_dir, hwm)
    if base is None and not paths:
        return spark.createDataFrame([], "Item_A string, Item_B string, Transacciones long")
    return _pair_sums(spark, base, paths).where(F.col("Transacciones") >= min_count)


# ------------------------------------------------------------- re-deliveries
def dedup_to(spark: SparkSession, raw_dir: str, out_dir: str, checkpoint: str, max_files: int | None = None):
    """Raw rows without re-deliveries (rows equal in store, transaction, date and product list).

    The state holds a fixed-size key for each row; the second part of a basket has another product list and
    stays, as does the same basket under another date.  Returns the finished query.
    """
    rows = cl.drop_headers(raw_stream(spark, raw_dir, max_files)).withColumn("_lista", F.sha2("ID_Productos_Raw", 256))
    kept = rows.dropDuplicates(["ID_Tienda", "ID_Transaccion", "Fecha", "_lista"]).drop("_lista")
    with _rocksdb(spark):
        return _run(kept.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
                    .option("path", out_dir))
