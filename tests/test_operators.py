"""Unit tests on planted fixtures (FIXTURES.md section 3)."""

import datetime as dt
import itertools
from collections import Counter

import pytest
from pyspark.sql import functions as F

from basketry.functions import calendar as cal
from basketry.functions.labels import cut
from basketry.operators import basket as bk
from basketry.operators import clean as cl
from basketry.operators import customers as cu
from basketry.operators import enrich as en
from basketry.operators import products as pr
from basketry.operators import recommend as rc
from basketry.operators import segment as sg
from basketry.operators import temporal as tm
from basketry.plans.session import fresh_path
from basketry.sources import text as tx


def _write_text(spark, lines):
    path = fresh_path(spark, "fixture")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


# ------------------------------------------------------------------ cleaning
def test_raw_dirty(spark):
    path = _write_text(spark, [
        "Fecha|ID_Tienda|ID_Transaccion|ID_Productos_Raw",
        "2013-01-02|102|1|20 3  1",
        "2013-01-02|102|2|7 x 7",
        "2013-01-03|103|3|",
        "2013-13-01|103|4|9",
        "bad|107|5|11",
    ])
    lines = cl.clean_lines(tx.read_transactions(spark, path))
    got = sorted((r.ID_Transaccion, r.ID_Producto, r.Fecha) for r in lines.collect())
    d = dt.date(2013, 1, 2)
    assert got == [(1, 1, d), (1, 3, d), (1, 20, d), (2, 7, d), (2, 7, d), (4, 9, None), (5, 11, None)]
    strict = cl.clean_lines(tx.read_transactions(spark, path), cl.CleanRules(require_date=True))
    assert strict.where(F.col("Fecha").isNull()).count() == 0


def test_raw_repeat_keeps_units(spark):
    raw = spark.createDataFrame([("2016-01-01", 102, 1, "5 12 5 7")], tx.TRANSACTION_SCHEMA)
    got = [r.ID_Producto for r in cl.clean_lines(raw).collect()]
    assert sorted(got) == [5, 5, 7, 12]


def test_dedup_rule(spark):
    raw = spark.createDataFrame([("2016-01-01", 102, 1, "5 6"), ("2016-01-01", 102, 1, "5 6")], tx.TRANSACTION_SCHEMA)
    assert cl.clean_lines(raw).count() == 4
    assert cl.clean_lines(raw, cl.CleanRules(dedup_raw=True)).count() == 2


# ------------------------------------------------------------------ catalogue
def test_catalog_orphan(spark):
    lines = spark.createDataFrame([(1, 10), (1, 11), (1, 12), (1, 13)], "ID_Transaccion long, ID_Producto long")
    pc = spark.createDataFrame([(10, 1), (11, 99), (13, 1), (13, 2)], "ID_Producto long, ID_Categoria int")
    cats = spark.createDataFrame([(1, "A"), (2, "B")], "ID_Categoria int, Nombre_Categoria string")
    out = en.enrich(lines, pc, cats)
    got = Counter((r.ID_Producto, r.Nombre_Categoria) for r in out.collect())
    # 11: category without a name; 12: no category; 13: two categories (reference semantics: two rows)
    assert got == Counter({(10, "A"): 1, (11, "DESCONOCIDA"): 1, (12, "DESCONOCIDA"): 1, (13, "A"): 1, (13, "B"): 1})
    one = en.one_category_per_product(out).where(F.col("ID_Producto") == 13).collect()
    assert one[0].Nombre_Categoria == "A"


# ------------------------------------------------------------------ rankings
def _sales(spark, rows):
    return spark.createDataFrame(rows, "ID_Transaccion long, ID_Tienda int, ID_Producto long, Fecha date, "
                                       "Nombre_Categoria string")


def test_ties_break_on_key(spark):
    d = dt.date(2020, 1, 1)
    rows = [(i, 1, p, d, "X") for i, p in enumerate([5, 5, 3, 3, 9, 9, 1])]
    top = pr.top_products(_sales(spark, rows), 2).collect()
    assert [(r.Posicion, r.ID_Producto) for r in top] == [(1, 3), (2, 5)]


def test_pareto_crossing_exactly(spark):
    d = dt.date(2020, 1, 1)
    # units 40, 40, 10, 10 -> cumulative 40 %, 80 %, 90 %, 100 %: two products within 80 %
    rows = [(i, 1, p, d, "X") for i, p in enumerate([1] * 40 + [2] * 40 + [3] * 10 + [4] * 10)]
    r = pr.pareto(_sales(spark, rows)).collect()[0]
    assert (r.Productos_Pareto, r.Productos_Total) == (2, 4)
    rows = [(i, 1, p, d, "X") for i, p in enumerate([1] * 50 + [2] * 31 + [3] * 19)]
    assert pr.pareto(_sales(spark, rows)).collect()[0].Productos_Pareto == 1


# ------------------------------------------------------------------ calendar
def test_week_label_matches_python(spark):
    days = [dt.date(y, m, d) for y in (2015, 2016, 2020, 2021) for m, d in ((12, 29), (12, 30), (12, 31), (1, 1),
                                                                          (1, 2), (1, 3), (1, 4), (2, 29) if y % 4 == 0
                                                                          else (2, 28))]
    df = spark.createDataFrame([(x,) for x in days], "Fecha date").select(
        "Fecha", cal.week_label("Fecha").alias("w"), F.weekofyear("Fecha").alias("iso"))
    for r in df.collect():
        assert r.w == r.Fecha.strftime("%Y-W%U")
        assert r.iso == r.Fecha.isocalendar()[1]
    assert spark.range(1).select(F.weekofyear(F.lit(dt.date(2020, 12, 31)))).first()[0] == 53


# ------------------------------------------------------------------ series
def test_seasonal_decompose_series_35(spark):
    pattern = [0, 1, 2, 3, 2, 1, 5]
    start = dt.date(2021, 1, 1)
    rows = [(start + dt.timedelta(days=i), float(10 + 0.5 * i + pattern[i % 7])) for i in range(35)]
    df = spark.createDataFrame(rows, "Fecha date, v double")
    out = tm.seasonal_decompose(df, "v").orderBy("Fecha").collect()
    trend = [r.Tendencia for r in out]
    assert trend[:3] == [None] * 3 and trend[-3:] == [None] * 3
    assert [round(r.Estacionalidad, 6) for r in out[:7]] == [-2, -1, 0, 1, 0, -1, 3]
    for r in out[3:-3]:
        assert abs(r.Tendencia + r.Estacionalidad + r.Residuo - r.v) < 1e-6


def test_moving_average_short_series(spark):
    start = dt.date(2021, 1, 1)
    rows = [(start + dt.timedelta(days=i * 2), float(i)) for i in range(6)]
    out = tm.moving_average(spark.createDataFrame(rows, "Fecha date, v double"), "v", windows=(7, 3)).orderBy(
        "Fecha").collect()
    assert all(r.MA_7 is None for r in out)
    assert [r.MA_3 for r in out] == [None, None, 1.0, 2.0, 3.0, 4.0]


# ------------------------------------------------------------------ gaps
def test_purchase_gaps_match_brute_force(spark):
    base = dt.date(2020, 1, 1)
    dates = [base] * 5 + [base + dt.timedelta(days=1)] * 2 + [base + dt.timedelta(days=21)] + \
            [base + dt.timedelta(days=22)] * 3
    b = spark.createDataFrame([(i, d) for i, d in enumerate(dates)], "ID_Transaccion long, Fecha_Compra date")
    got = {r.Dias: r.Peso for r in cu.purchase_gaps(b).collect()}
    s = sorted(dates)
    brute = Counter((b2 - a).days for a, b2 in zip(s, s[1:]))
    assert got == dict(brute)
    st = cu.gap_stats(cu.purchase_gaps(b)).collect()[0]
    assert st.Num_Intervalos == len(dates) - 1 and st.Maximo == 20


# ------------------------------------------------------------------ bands
def test_bands_right_closed(spark):
    df = spark.createDataFrame([(u, r) for u, r in zip([5, 6, 15, 16, 30, 31], [0, 30, 31, 60, 90, 91])],
                               "Productos_Comprados long, Recencia_Dias int")
    out = cu.rf_labels(df).orderBy("Productos_Comprados").collect()
    assert [r.Frecuencia_Categoria for r in out] == [
        "Baja (1-5)", "Media (6-15)", "Media (6-15)", "Alta (16-30)", "Alta (16-30)", "Muy Alta (>30)"]
    assert [r.Recencia_Categoria for r in out] == [
        None, "Muy Reciente (<30d)", "Reciente (30-60d)", "Reciente (30-60d)", "Moderado (60-90d)", "Antiguo (>90d)"]
    assert out[0].Segmento_RFM == "nan / Baja (1-5)"
    seg = cu.size_segments(df.withColumnRenamed("Productos_Comprados", "Productos_Comprados"))
    assert {r.Segmento_Tamano: r.Total_Transacciones for r in seg.collect()} == {
        cu.SIZE_LABELS[0]: 1, cu.SIZE_LABELS[1]: 2, cu.SIZE_LABELS[2]: 2, cu.SIZE_LABELS[3]: 1}
    col = cut(F.col("x"), (0, 1, float("inf")), ("a", "b"))
    assert [r[0] for r in spark.createDataFrame([(0,), (1,), (2,)], "x int").select(col).collect()] == [None, "a", "b"]


# ------------------------------------------------------------------ K-Means
def test_blobs_partition_equality(spark):
    centers = [(0, 0), (0, 100), (100, 0), (100, 100)]
    rows = [(i * 10 + j, float(cx + j % 3), float(cy + j % 2)) for i, (cx, cy) in enumerate(centers) for j in range(10)]
    rf = spark.createDataFrame(rows, "ID_Transaccion long, Recencia_Dias double, Productos_Comprados double")
    _, scaled = sg.scale(rf)
    _, out = sg.fit_clusters(scaled, 4, 42)
    groups = {}
    for r in out.collect():
        groups.setdefault(r.ID_Transaccion // 10, set()).add(r.Cluster)
    assert all(len(v) == 1 for v in groups.values())
    assert len({next(iter(v)) for v in groups.values()}) == 4
    fixed = sg.assign(rf, [(-1, -1), (-1, 1), (1, -1), (1, 1)]).collect()
    assert {r.ID_Transaccion // 10: r.Cluster for r in fixed} == {0: 0, 1: 1, 2: 2, 3: 3}


# ------------------------------------------------------------------ baskets
def _planted(spark):
    baskets = [[4, 3, 7]] * 6 + [[4, 3]] * 2 + [[4, 9]] * 4 + [[7, 17, 70]] * 3 + [[1, 2]] * 5
    rows = [(i, 1, it) for i, b in enumerate(baskets) for it in b]
    lines = spark.createDataFrame(rows, "ID_Transaccion long, ID_Tienda int, Item int")
    return baskets, bk.baskets(lines, "Item", min_size=2)


def test_planted_rules(spark):
    baskets, b = _planted(spark)
    n = len(baskets)
    its, rules = bk.mine(b, min_support=0.1, min_confidence=0.5)
    r = {(tuple(x.antecedent), tuple(x.consequent)): x for x in rules.collect()}
    rule = r[(("3", "4"), ("7",))]
    assert rule.support == pytest.approx(6 / n)
    assert rule.confidence == pytest.approx(6 / 8)
    assert rule.lift == pytest.approx((6 / 8) / (9 / n))
    full = bk.rules_full(its, F.lit(n), min_lift=None).collect()
    sets = [frozenset(x) for x in baskets]

    def freq(s):
        return sum(1 for x in sets if s <= x)

    for x in full:
        a = frozenset(int(v) for v in x.Antecedente_Str.split(","))
        c = frozenset(int(v) for v in x.Consecuente_Str.split(","))
        assert x.Soporte == pytest.approx(round(freq(a | c) / n, 6))
        assert x.Confianza == pytest.approx(round(freq(a | c) / freq(a), 6))
    multi = [x for x in full if x.Long_Consecuente == 2]
    assert multi, "multi-item consequents expected"


def test_recommend_is_containment_not_substring(spark):
    _, b = _planted(spark)
    _, rules = bk.mine(b, min_support=0.1, min_confidence=0.1)
    got = rc.for_product(rules, "7", 50).collect()
    assert got and all("7" in r.Antecedente_Str.split(",") for r in got)


def test_few_baskets_are_mined_and_none_is_typed_empty(spark):
    lines = spark.createDataFrame([(i, 1, it) for i in range(4) for it in (1, 2)],
                                  "ID_Transaccion long, ID_Tienda int, Item int")
    its, rules = bk.mine(bk.baskets(lines, "Item"))
    assert sorted((tuple(r["items"]), r.freq) for r in its.collect()) == [(("1",), 4), (("1", "2"), 4), (("2",), 4)]
    assert rules.count() == 2
    its, rules = bk.mine(bk.baskets(lines.limit(0), "Item"))
    assert its.count() == 0 and rules.count() == 0
    assert its.schema == bk.ITEMSET_SCHEMA and rules.schema == bk.RULE_SCHEMA


def test_rules_from_equals_fp_growth_rules(spark):
    _, b = _planted(spark)
    its, rules = bk.mine(b, 0.1, 0.3)
    key = lambda df: sorted((tuple(r.antecedent), tuple(r.consequent), round(r.confidence, 9), round(r.lift, 9),
                             round(r.support, 9)) for r in df.collect())
    assert key(bk.rules_from(its, F.lit(b.count()), 0.3)) == key(rules) != []


def test_each_store_is_mined_at_its_own_threshold(spark):
    import random
    rnd = random.Random(4)
    rows = [(s, t, it) for s, n in ((1, 1500), (2, 50)) for t in range(n) for it in rnd.sample(range(100), 12)]
    df = spark.createDataFrame(rows, "ID_Tienda int, ID_Transaccion long, Item int")
    b = bk.baskets(df, "Item")
    its, rules = bk.mine_by_key(b, "ID_Tienda", 0.04, 0.2, stage=lambda d, n: d.cache())
    got = {(r.ID_Tienda, tuple(r["items"])): r.freq for r in its.collect()}
    items = {}
    for s, t, it in rows:
        items.setdefault((s, t), set()).add(it)
    for s, need in ((1, 60), (2, 2)):
        brute = Counter(tuple(map(str, c)) for (k, _), v in items.items() if k == s for n in (1, 2)
                        for c in itertools.combinations(sorted(v, key=str), n))
        want = {(s, c): n for c, n in brute.items() if n >= need}
        assert {k: v for k, v in got.items() if k[0] == s and len(k[1]) <= 2} == want
    own = bk.mine(b.where("ID_Tienda = 2"), 0.04, 0.2)
    assert {(2, tuple(r["items"])): r.freq for r in own[0].collect()} == {k: v for k, v in got.items() if k[0] == 2}
    assert sorted((tuple(r.antecedent), tuple(r.consequent)) for r in own[1].collect()) == \
        sorted((tuple(r.antecedent), tuple(r.consequent)) for r in rules.where("ID_Tienda = 2").collect())
    none = bk.mine_by_key(b.limit(0), "ID_Tienda")
    assert none[0].count() == none[1].count() == 0


def test_one_gap_constant_feature_and_two_stores(spark):
    from basketry.operators import customers as cu
    from basketry.operators import kpi
    from basketry.operators import segment as sg
    gap = cu.gap_stats(spark.createDataFrame([(3, 1)], "Dias int, Peso long")).first()
    assert (gap.Num_Intervalos, gap.Media, gap.Desv_Std) == (1, 3.0, None)
    rf = spark.createDataFrame([(1, 1, 5, 2), (1, 2, 5, 8)],
                               "ID_Tienda int, ID_Transaccion long, Recencia_Dias int, Productos_Comprados long")
    z = sg.assign(rf, ((0.0, -1.0), (0.0, 1.0)))
    assert sorted((r.Z_Recencia_Dias, r.Cluster) for r in z.collect()) == [(0.0, 0), (0.0, 1)]
    d = dt.date(2020, 1, 1)
    s = _sales(spark, [(7, 1, 5, d, "A"), (7, 2, 5, d, "A"), (7, 2, 6, d, "A")])  # one number in two stores
    assert kpi.kpi_summary(s).first().Total_Transacciones == 2
    assert kpi.dataset_dimensions(s).first().Transacciones == 2
    assert pr.top_products(s, 1, "reach").first().Num_Transacciones == 2
    assert [r.Num_Productos for r in cu.largest_baskets(s, 5).collect()] == [2, 1]


def test_top_plus_others_counts_products(spark):
    d = dt.date(2020, 1, 1)
    s = _sales(spark, [(i, 1, p, d, "A") for p in range(5) for i in range(p + 1)])
    got = [(r.Posicion, r.Producto, r.Unidades_Vendidas) for r in pr.top_plus_others(s, 2).orderBy("Posicion").collect()]
    assert got == [(1, "4", 5), (2, "3", 4), (3, "Otros", 6)]


def test_next_items_with_whole_antecedents(spark):
    from basketry.operators import recommend as rc
    rules = spark.createDataFrame([(["a", "b"], ["c"], .5, 2.0, .1), (["a"], ["b"], .5, 3.0, .1), (["c", "d"], ["a"], .5, 1.5, .1)],
                                  "antecedent array<string>, consequent array<string>, confidence double, lift double, support double")
    b = spark.createDataFrame([(1, 1, ["a", "b"]), (1, 2, ["a"]), (1, 3, ["c", "d", "x"]), (1, 4, ["d"])],
                              "ID_Tienda int, ID_Transaccion long, items array<string>")
    got = sorted((r.ID_Transaccion, r.Antecedente_Str, r.Consecuente_Str) for r in rc.next_items(rules, b).collect())
    assert got == [(1, "a,b", "c"), (2, "a", "b"), (3, "c,d", "a")]
    l2 = rc.for_baskets(rules, b, 1).collect()
    assert sorted((r.ID_Transaccion, r.Antecedente_Str, r.Historial) for r in l2) == [
        (1, "a", "a,b"), (2, "a", "a"), (3, "c,d", "c,d,x"), (4, "c,d", "d")]


def test_cooccurrence_matches_brute_force(spark):
    baskets, b = _planted(spark)
    got = {(r.Item_A, r.Item_B): r.Transacciones for r in bk.cooccurrence(b, min_count=3).collect()}
    brute = Counter(p for x in baskets for p in itertools.combinations(sorted(set(x)), 2))
    assert got == {p: c for p, c in brute.items() if c >= 3}


def test_sample_is_stable(spark):
    _, b = _planted(spark)
    a1 = sorted(r.ID_Transaccion for r in bk.sample_baskets(b, 0.5, seed=7).collect())
    a2 = sorted(r.ID_Transaccion for r in bk.sample_baskets(b.repartition(3), 0.5, seed=7).collect())
    assert a1 == a2
    assert sorted(r.ID_Transaccion for r in bk.sample_baskets(b, modulo=3).collect()) == \
        sorted(r.ID_Transaccion for r in b.collect() if r.ID_Transaccion % 3 == 0)


def test_generic_top_n_and_heatmap(spark):
    d = dt.date(2020, 1, 1)
    rows = [(i, s, p, d, c) for i, (s, p, c) in enumerate([(1, 5, "A"), (1, 5, "A"), (2, 3, "B"), (2, 3, "B"),
                                                           (2, 9, "B"), (3, 1, "C")])]
    s = _sales(spark, rows)
    top = pr.top_n(s, "Nombre_Categoria", 2, share=True).collect()
    assert [(r.Nombre_Categoria, r.Unidades_Vendidas) for r in top] == [("B", 3), ("A", 2)]
    assert top[0].Porcentaje == 50.0
    low = pr.bottom_n(s, "ID_Tienda", 1, measure="reach").collect()
    assert (low[0].ID_Tienda, low[0].Num_Transacciones) == (3, 1)
    hm = {r.ID_Tienda: (r.C5, r.C3) for r in tm.heatmap(s, "ID_Tienda", "ID_Producto", [5, 3], rows=[1, 2, 3, 4])
          .collect()}
    assert hm == {1: (2, 0), 2: (0, 2), 3: (0, 0), 4: (0, 0)}


def test_mine_by_key_equals_per_key_mining(spark):
    store1 = [[1, 2, 3]] * 6 + [[1, 2]] * 4 + [[3, 4]] * 5
    store2 = [[1, 2]] * 3 + [[2, 5]] * 9 + [[5, 6, 2]] * 4 + [[7, 8]] * 2
    rows = [(i, s, it) for s, bs in ((1, store1), (2, store2)) for i, b in enumerate(bs) for it in b]
    lines = spark.createDataFrame(rows, "ID_Transaccion long, ID_Tienda int, Item int")
    b = bk.baskets(lines, "Item")
    its, rules = bk.mine_by_key(b, "ID_Tienda", min_support=0.2, min_confidence=0.5)
    got_its = {(r.ID_Tienda, tuple(r["items"])): r.freq for r in its.collect()}
    got_rules = {(r.ID_Tienda, tuple(r.antecedent), tuple(r.consequent)): (round(r.confidence, 9), round(r.lift, 9),
                                                                          round(r.support, 9))
                 for r in rules.collect()}
    want_its, want_rules = {}, {}
    for s in (1, 2):
        i_s, r_s = bk.mine(b.where(F.col("ID_Tienda") == s), min_support=0.2, min_confidence=0.5)
        want_its.update({(s, tuple(r["items"])): r.freq for r in i_s.collect()})
        want_rules.update({(s, tuple(r.antecedent), tuple(r.consequent)): (round(r.confidence, 9), round(r.lift, 9),
                                                                           round(r.support, 9))
                           for r in r_s.collect()})
    assert got_its == want_its
    assert got_rules == want_rules


def test_undated_lines_have_no_period(spark):
    rows = [(1, 1, 5, dt.date(2020, 1, 1), "X"), (2, 1, 5, None, "X")]
    s = _sales(spark, rows).withColumn("DiaSemana_L0", F.weekday("Fecha")).withColumn("Mes", F.month("Fecha"))
    assert [r.Fecha for r in tm.period_sales(s, "day").collect()] == [dt.date(2020, 1, 1)]
    assert sum(r.Total_Productos for r in tm.by_weekday(s).collect()) == 1
    assert [r.Mes for r in tm.by_month(s).collect()] == [1]


def test_pareto_ranks_bucketed_equals_brute_force(spark):
    import random as _r
    rng = _r.Random(5)
    d = dt.date(2020, 1, 1)
    units = {p: rng.choice([1, 1, 1, 2, 2, 3, 7]) for p in range(1, 200)}
    rows = [(i, 1, p, d, "X") for i, (p, u) in enumerate((p, u) for p, u in units.items() for _ in range(u))]
    got = {r.ID_Producto: (r.Posicion, r.Porcentaje_Acumulado)
           for r in pr.pareto_ranks(_sales(spark, rows), bucket=7).collect()}
    order = sorted(units, key=lambda p: (-units[p], p))
    total, cum, want = sum(units.values()), 0, {}
    for i, p in enumerate(order, 1):
        cum += units[p]
        want[p] = (i, round(cum * 100.0 / total, 6))
    assert {p: g[0] for p, g in got.items()} == {p: w[0] for p, w in want.items()}
    assert all(abs(got[p][1] - want[p][1]) < 1e-9 for p in want)


def test_approx_distinct_options(spark):
    from basketry.operators import kpi
    d = dt.date(2020, 1, 1)
    rows = [(i % 50, 1, i % 37, d, "X") for i in range(500)]
    s = _sales(spark, rows)
    exact = kpi.kpi_summary(s).first()
    approx = kpi.kpi_summary(s, approx=True).first()
    assert (exact.Total_Transacciones, exact.Productos_Unicos) == (50, 37)
    assert abs(approx.Total_Transacciones - 50) <= 2 and abs(approx.Productos_Unicos - 37) <= 2
    assert kpi.dataset_dimensions(s, approx=True).first().Tiendas == 1
