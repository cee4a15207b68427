"""Hot keys: one basket holds a third of all lines and one product a third of
all units.  The operators must stay exact (no capping or sampling) and keep
per-basket state bounded by distinct items, not by lines."""

import datetime as dt
import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from basketry.operators import basket as bk
from basketry.operators import customers as cu
from basketry.operators import products as pr


def _skewed(spark, n=30000, seed=3):
    rnd = random.Random(seed)
    base = dt.date(2020, 1, 1)
    rows = []
    for i in range(n):
        if i < n // 3:
            txn, store = 0, 1                      # the hot basket
        else:
            txn, store = 1 + i % 4000, 2 + i % 5
        prod = 7 if i % 3 == 0 else rnd.randint(1, 60)   # the hot product
        rows.append((txn, store, prod, base + dt.timedelta(days=txn % 40), "X"))
    df = spark.createDataFrame(rows, "ID_Transaccion long, ID_Tienda int, ID_Producto long, Fecha date, "
                                     "Nombre_Categoria string")
    return rows, df


def test_hot_basket_and_product(spark):
    rows, s = _skewed(spark)
    units = Counter(r[2] for r in rows)
    top = pr.top_products(s, 3).collect()
    want = sorted(units.items(), key=lambda kv: (-kv[1], kv[0]))[:3]
    assert [(r.ID_Producto, r.Unidades_Vendidas) for r in top] == want

    b = cu.basket_table(s).where(F.col("ID_Transaccion") == 0).first()
    assert b.Productos_Comprados == len(rows) // 3

    lines = s.select("ID_Tienda", "ID_Transaccion", F.col("ID_Producto").alias("Item"))
    baskets = bk.baskets(lines, "Item")
    hot = baskets.where(F.col("ID_Transaccion") == 0).first()
    assert len(hot["items"]) == len({r[2] for r in rows if r[0] == 0})   # a set: bounded by distinct items

    items = defaultdict(set)
    for r in rows:
        items[(r[1], r[0])].add(r[2])
    pairs = Counter()
    for its in items.values():
        its = sorted(its)
        for i in range(len(its)):
            for j in range(i + 1, len(its)):
                pairs[(its[i], its[j])] += 1
    got = {(r.Item_A, r.Item_B): r.Transacciones for r in bk.cooccurrence(baskets, min_count=3).collect()}
    assert got == {p: c for p, c in pairs.items() if c >= 3}


def test_hot_date_gaps(spark):
    rows, s = _skewed(spark)
    b = cu.basket_table(s)
    got = {r.Dias: r.Peso for r in cu.purchase_gaps(b).collect()}
    dates = sorted(r.Fecha_Compra for r in b.collect())
    want = Counter((y - x).days for x, y in zip(dates, dates[1:]))
    assert got == dict(want)


def test_pairs_of_one_very_large_basket(spark):
    """Thousands of distinct items in one basket: pairs stream out position by position."""
    lines = spark.range(3000).select(F.lit(1).alias("ID_Tienda"), F.lit(0).cast("long").alias("ID_Transaccion"), F.col("id").alias("Item"))
    more = spark.range(3000).select(F.lit(1).alias("ID_Tienda"), (1 + F.floor(F.col("id") / 2)).cast("long").alias("ID_Transaccion"),
                                    F.col("id").alias("Item"))
    b = bk.baskets(lines.unionByName(more), "Item")
    got = bk.cooccurrence(b, min_count=2)
    assert got.count() == 1500 and got.where("Item_B - Item_A <> 1").count() == 0
