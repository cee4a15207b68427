"""The fact bucketed by basket, and distinct counts from mergeable sketches."""

import datetime as dt
import random

from pyspark.sql import functions as F

from basketry.operators import basket as bk
from basketry.operators import customers as cu
from basketry.operators import sketches as sk
from basketry.plans import facts
from basketry.plans.session import fresh_path
from basketry.sources import sinks


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    """Shuffles of the plan, without those of scalar subqueries (which the plan lists after the tree)."""
    tree = plan(df).split("Subqueries")[0]
    return [x for x in tree.splitlines() if "Exchange hashpartitioning" in x or "Exchange rangepartitioning" in x]


def test_baskets_and_rf_features_need_no_shuffle_of_the_fact(spark, sf):
    s = facts.sales_by_basket(spark, sf)
    day = dt.date(1999, 1, 1)
    for df in (cu.basket_table(s), cu.rf_features(s.drop("ID_Producto").withColumn("ID_Producto", F.lit(1)), as_of=day),
               cu.rf_features(s, as_of=day), bk.baskets(facts.item_lines(spark, sf), "Item"),
               bk.baskets(s.withColumnRenamed("ID_Producto", "Item"), "Item")):
        assert not exchanges(df), plan(df)
    assert exchanges(cu.basket_table(facts.sales(spark, sf)))


def test_bucketed_fact_holds_the_same_rows(spark, sf):
    cols = list(facts.BUCKETED_COLUMNS)
    key = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*cols).cast("decimal(38,0)"))).first()
    assert key(facts.sales_by_basket(spark, sf)) == key(facts.sales(spark, sf))
    assert sorted(cu.rf_features(facts.sales_by_basket(spark, sf)).collect()) == sorted(cu.rf_features(facts.sales(spark, sf)).collect())


def test_write_bucketed_with_null_keys_repeats_and_no_rows(spark):
    rows = [(None, 1, "a"), (None, 1, "a"), (2, None, "b"), (2, 5, None)] * 3
    df = spark.createDataFrame(rows, "k int, t long, v string")
    for n, frame in (("full", df), ("none", df.limit(0))):
        out = sinks.write_bucketed(frame, f"layout_{n}", fresh_path(spark, f"layout-{n}"), ("k", "t"), 3)
        counts = out.groupBy("k", "t").agg(F.count(F.lit(1)).alias("n"))
        assert not exchanges(counts)
        assert sorted(map(str, counts.collect())) == sorted(map(str, frame.groupBy("k", "t").agg(F.count(F.lit(1)).alias("n")).collect()))


SALES = "Fecha date, ID_Tienda int, ID_Transaccion long, ID_Producto int, Nombre_Categoria string"


def test_sketches_of_any_slice_keep_their_bound(spark):
    rng, start = random.Random(3), dt.date(2020, 1, 1)
    rows = [(start + dt.timedelta(rng.randrange(60)), rng.randrange(5), rng.randrange(4000), rng.randrange(9000),
             "c%d" % rng.randrange(30)) for _ in range(40000)]
    daily = sk.daily_sketches(spark.createDataFrame(rows, SALES).repartition(7)).cache()
    assert daily.count() == len({r[:2] for r in rows})
    for stores, a, b in ((None, 0, 59), ([1], 0, 59), ([0, 4], 10, 30), (None, 7, 7), ([3], 5, 5), ([99], 0, 59)):
        d0, d1 = start + dt.timedelta(a), start + dt.timedelta(b)
        part = [r for r in rows if d0 <= r[0] <= d1 and (stores is None or r[1] in stores)]
        got = sk.kpi_of(daily, stores, d0.isoformat(), d1.isoformat()).first()
        assert got.Unidades == len(part)
        for name, exact in (("Productos", len({r[3] for r in part})), ("Categorias", len({r[4] for r in part})),
                            ("Transacciones", len({r[1:3] for r in part}))):
            assert abs(got[name] - exact) <= max(1, sk.bound() * exact), (name, got[name], exact)


def test_sketches_count_no_nulls_and_read_only_the_small_table(spark, sf):
    day = dt.date(2020, 1, 1)
    df = spark.createDataFrame([(day, 1, 1, None, None), (day, 1, 1, 7, "a"), (day, 1, 2, 7, "a")], SALES)
    got = sk.kpi_of(sk.daily_sketches(df)).first()
    assert (got.Unidades, got.Productos, got.Categorias, got.Transacciones) == (3, 1, 1, 2)
    none = sk.kpi_of(sk.daily_sketches(df.limit(0))).first()
    assert tuple(none) == (0, 0, 0, 0)
    p = plan(sk.kpi_of(facts.sketch_facts(spark, sf), [1, 2], "1996-01-01", "1996-12-31"))
    assert "ID_Producto" not in p and "PushedFilters" in p and "GreaterThanOrEqual(Fecha" in p


def test_the_fact_is_shuffled_without_its_calendar_columns(spark, sf, monkeypatch):
    plans = []
    writer = type(spark.range(1).write)
    monkeypatch.setattr(writer, "parquet", lambda self, path, **_: plans.append(self._df._jdf.queryExecution().optimizedPlan().toString()))
    facts.build_sales(spark, sf)
    above, below = plans[0].split("RebalancePartitions")
    assert "HoraDelDia" in above and "Semana_Anio" in above
    assert not any(c in below for c in ("HoraDelDia", "Semana_Anio", "DiaSemana", "Dia_Semana"))


def test_lines_by_basket_do_not_wait_for_the_wide_fact(spark, sf):
    want = facts.sales(spark, sf).count()
    facts.forget(spark)
    try:
        assert facts.sales_by_basket(spark, sf).count() == want
        assert not facts._STAGES  # not written for them
    finally:
        facts.forget(spark)


def test_mining_groups_follow_the_cores_not_the_input(spark, monkeypatch):
    from pyspark.ml.fpm import FPGrowth

    rows = [(i, [c for j, c in enumerate("abcd") if i >> j & 1]) for i in range(1, 16)] * 20
    b = spark.createDataFrame(rows, "ID_Transaccion int, items array<string>").repartition(60)
    seen, fit = [], FPGrowth.fit

    def looked_at(self, df):
        seen.append(self.getNumPartitions())
        return fit(self, df)

    monkeypatch.setattr(FPGrowth, "fit", looked_at)
    got = {tuple(r["items"]): r["freq"] for r in bk.mine(b, 0.01, 0.5)[0].collect()}
    assert got == {tuple(s): 20 * sum(set(s) <= set(t) for _, t in rows[:15]) for _, s in rows[:15]}
    assert seen == [spark.sparkContext.defaultParallelism]


def retail(spark, root):
    """Tables with repeated and null keys: a product that comes twice, one without a brand, orders without a customer."""
    rng = random.Random(11)
    brands = [f"B{i}" for i in range(6)]
    part = [(i, brands[i % 6] if i else None, f"T{i % 3}", i % 50) for i in range(40)] + [(7, "B1", "T1", 7), (7, "B3", "T0", 7)]
    orders = [(i, i % 9 if i % 8 else None, dt.datetime(2020, 1, 1 + i % 28)) for i in range(300)] + [(None, 1, None), (5, 2, None)]
    lines = [(rng.choice([*range(300), None]), rng.choice([*range(45), None])) for _ in range(1500)]
    for name, rows, schema in (("part", part, "p_partkey int, p_brand string, p_type string, p_size int"),
                               ("orders", orders, "o_orderkey long, o_custkey int, o_orderdate timestamp"),
                               ("customer", [(i, i % 4 if i else None) for i in range(9)], "c_custkey int, c_nationkey int"),
                               ("lineitem", lines, "l_orderkey long, l_partkey int")):
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    return str(root)


def test_mining_baskets_do_not_wait_for_the_lines_by_basket(spark, tmp_path):
    root = retail(spark, tmp_path)
    key = lambda df: sorted((str(r.ID_Tienda), r.ID_Transaccion, tuple(r["items"])) for r in df.collect())
    got = key(facts.mining_baskets(spark, root))
    assert len(got) > 100 and any(s == "None" for s, _, _ in got)
    assert not [k for k in facts._BUCKETED if k[1] == root and k[2] == "sales-by-basket"]  # not written for them
    assert got == key(bk.baskets(facts.item_lines(spark, root), "Item"))
    facts._BUCKETED.pop((*facts._key(spark, root), f"mining-baskets-{facts.MINING_ITEM}"))
    assert got == key(facts.mining_baskets(spark, root))  # now from the lines by basket


def test_recommendations_gather_baskets_without_shuffle_or_broadcast_of_them(spark, sf, tmp_path):
    from basketry.operators import recommend as rc

    spark.createDataFrame([(["Brand#11"], ["Brand#12"], .5, 1.5, .1)],
                          "antecedent array<string>, consequent array<string>, confidence double, lift double, support double") \
        .write.parquet(f"{tmp_path}/rules")
    df = rc.for_baskets(spark.read.parquet(f"{tmp_path}/rules"), facts.mining_baskets(spark, sf), 3)
    assert not [x for x in exchanges(df) if "ID_Transaccion" in x], plan(df)
    joins = [x for x in plan(df).splitlines() if "Join" in x]
    assert len(joins) == 3 and not [x for x in joins if "BuildLeft" in x], plan(df)
    assert [x for x in joins if "ID_Transaccion" in x and "SortMergeJoin" in x], plan(df)
    assert "WindowGroupLimit [ID_Tienda" not in plan(df)  # rules' texts are not sorted by basket


def test_mining_shuffles_its_baskets_once(spark, tmp_path, monkeypatch):
    from pyspark.ml.fpm import FPGrowth

    root = retail(spark, tmp_path)
    plans, fit = [], FPGrowth.fit

    def looked_at(self, df):
        plans.append(plan(df))
        return fit(self, df)

    monkeypatch.setattr(FPGrowth, "fit", looked_at)
    its, _ = facts.mined(spark, root)
    want = {tuple(r["items"]): r["freq"] for r in bk.mine(facts.mining_baskets(spark, root), facts.MINING_MIN_SUPPORT, 0.5)[0].collect()}
    assert {tuple(r["items"]): r["freq"] for r in its.collect()} == want and len(want) > 6
    assert "Exchange" not in plans[0] and "Exchange" in plans[1]
    folder = fresh_path(spark, "x").rsplit("/", 1)[0]
    assert not [r for r in names_in(spark, folder) if r.startswith("transactions-")]  # given up once mined


def names_in(spark, folder):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(path)]
